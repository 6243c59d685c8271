"""Personal data by a linear-chain conditional random field over word shapes.

Method: a line is a sequence of words. Each word has shape features (character
classes with run lengths, marks, digits, cue words of the training table), and
the word before and after lend theirs. A linear-chain CRF over begin/inside
labels is trained on a small labelled table by full-batch gradient steps
(forward-backward in numpy) and decoded by Viterbi over batches of lines of
similar length. Base patterns with exact checks (given) are kept; spans that
the CRF adds overlap none of them.

A document's lines are decoded whole, lines of similar length together. Spans
may touch: a beginning follows any word, only an inside word needs its own kind
before it.

Training data: ``LABELLED``, at most ``MAX_ROWS`` rows of any table given
instead, on the driver; the model (a few thousand weights) goes to the tasks.

Contract: null and empty texts have no spans; repeated rows give repeated
results; an empty table gives an empty result; extra columns are carried along;
an empty labelled table is an error.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import process_memo, read_table
from .pii_labelled import LABELLED
from .spans import Span, digests, matches, outside, with_spans

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "name", "id")
LABELS = ["O", *[f"{p}-{k}" for k in KINDS for p in "BI"]]
#: Rows of a labelled table that are read at most.
MAX_ROWS = 5_000
STEPS, RATE, PENALTY = 250, 1.0, 0.002
#: Probability, given the whole line, with which just these words must make up a span of its kind.
MIN_POSTERIOR = 0.7
#: Words remembered per Python worker.
MEMO_WORDS = 300_000

# --- base patterns ---------------------------------------------------------

_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> list[Span]:
    """The local part is the run of its characters before an ``@``, so each ``@`` is looked at once."""
    out, end = [], 0
    for m in _TAIL.finditer(text):
        before = text[max(end, text.rfind("@", end, m.start()) + 1) : m.start()]
        start = m.start() - (len(before) - len(before.rstrip(_LOCAL)))
        if start < m.start():
            out.append(("email", start, m.end()))
            end = m.end()
    return out


def _small_parts(m: re.Match) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))


def _luhn(m: re.Match) -> bool:
    digits = [int(c) for c in m[0] if c not in " -"]
    if not 12 <= len(digits) <= 19:
        return False
    doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(doubled) + sum(digits[-1::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    found = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        found += matches(_IP, text, "ip", _small_parts)
        found += matches(_CARD, text, "card", lambda m: m.end() - m.start() >= 12 and _luhn(m))
        if "+" in text:
            found += matches(_PHONE, text, "phone", lambda m: 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15)
    return found


# --- words and features ------------------------------------------------------

_EDGE = ".,;:!?()[]{}<>\"'*#$%&|"
_AGAIN = re.compile(r"(.)\1+", re.S)
_RUNS = re.compile(r"[A-Z]+|[a-z]+|[0-9]+|[^\W\d_]+|.", re.S)


def shape(word: str) -> str:
    """Character classes with run lengths up to 4: ``Abc-123`` is ``X1x2-d3``."""
    out = []
    for run in _RUNS.findall(word):
        c = run[0]
        kind = "d" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c
        out.append(f"{kind}{min(len(run), 4)}" if kind in "dXx" else kind)
    return "".join(out)


def _case(core: str) -> str:
    return "low" if core.islower() else "cap" if core[1:].islower() or len(core) == 1 else "up"


def features(word: str, cues: frozenset[str]) -> list[str]:
    """Features of a word on its own; the same strings serve for its neighbours."""
    core = word.strip(_EDGE)
    if not core:
        return ["mark=" + _AGAIN.sub(r"\1\1", word)]
    lower = core.lower()
    digits = sum("0" <= c <= "9" for c in core)
    out = ["word", f"end={word[-1]}" if word[-1] in _EDGE else "end="]
    if lower in cues:
        out.append("cue=" + lower)
    if core.isalpha():
        return [*out, "case=" + _case(core)]
    full = shape(core)
    return [*out, "shape=" + full, "kinds=" + re.sub(r"\d+", "", full), f"digits={min(digits, 20)}", f"at={'@' in core}",
            f"dots={min(core.count('.'), 4)}", f"all={digits == len(core)}"]


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def parse_row(marked: str) -> tuple[list[str], list[str]]:
    """Words and labels of a row that marks spans as ``[kind|text]``."""
    words, labels = [], []
    for part in re.split(r"(\[[a-z]+\|[^\]]*\]\S*)", marked):
        m = re.match(r"\[([a-z]+)\|([^\]]*)\](\S*)", part)
        if not m:
            found = part.split()
            words += found
            labels += ["O"] * len(found)
        else:
            inside = m[2].split()
            words += [*inside[:-1], inside[-1] + m[3]]
            labels += [("B-" if i == 0 else "I-") + m[1] for i in range(len(inside))]
    return words, labels


# --- model -------------------------------------------------------------------


class Crf:
    """Weights of a trained field; emissions are sums over a word's and its neighbours' features."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray, cues: frozenset[str]):
        self.index, self.weights, self.moves, self.cues = index, weights, moves, cues
        inner = moves.copy()
        for j, label in enumerate(LABELS):  # inside follows only its own kind
            for i, before in enumerate(LABELS):
                if label[0] == "I" and before[2:] != label[2:]:
                    inner[i, j] = -1e4
        self.first = np.array([-1e4 if x[0] == "I" else 0.0 for x in LABELS])
        self.inner = inner
        self.words = _WordClasses(self)
        self.plain: dict[tuple[str, str], int] = {}
        self.classes: dict[tuple[str, ...], int] = {}
        self.rows: list[np.ndarray] = [np.zeros((3, len(LABELS)))]  # class 0: beyond the line

    def class_of(self, word: str) -> int:
        """Words of equal features share a class, and so their emissions."""
        core = word.strip(_EDGE)
        if core.isalpha() and core.lower() not in self.cues:  # most words: only the end and the case count
            key = (word[-1] if word[-1] in _EDGE else "", _case(core))
            if key not in self.plain:
                self.plain[key] = self._class(features(word, self.cues))
            return self.plain[key]
        return self._class(features(word, self.cues))

    def _class(self, feats: list[str]) -> int:
        feats = tuple(feats)
        if feats not in self.classes:
            self.classes[feats] = len(self.rows)
            known = [self.index[f] for f in feats if f in self.index]
            self.rows.append(self.weights[:, known].sum(axis=1))
        return self.classes[feats]

    def emissions(self, lines: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Scores (words, labels) of all words of all lines, and the lines' ends."""
        if len(self.words) > MEMO_WORDS:
            self.words.clear()
        number = self.words.__getitem__
        ids = np.array([c for line in lines for c in map(number, line)], dtype=np.int64)
        table = np.stack(self.rows).astype(np.float32)
        ends = np.cumsum([len(line) for line in lines])
        before, after = np.r_[0, ids[:-1]], np.r_[ids[1:], 0]
        starts = np.r_[0, ends[:-1]]
        before[starts], after[ends - 1] = 0, 0
        return table[ids, 0] + table[before, 1] + table[after, 2], ends

    def decode(self, lines: list[list[str]]) -> list[tuple[list[int], list[float]] | None]:
        """Best labels of each line (no empty ones) and the probability of each word's span; None where all are outside."""
        scores, ends = self.emissions(lines)
        starts = np.r_[0, ends[:-1]]
        out: list = [None] * len(lines)
        lengths = ends - starts
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):  # lines of similar length, at most 2^18 padded words at once
            longest = max(1, (1 << 18) // max(1, int(lengths[order[at]]) * 2))
            group = order[at : at + longest]
            group = group[lengths[group] <= 2 * lengths[group[0]]]
            at += len(group)
            for i, path in zip(group.tolist(), self._viterbi(scores, starts[group], lengths[group]), strict=True):
                if path:
                    out[i] = path, self._posteriors(scores[starts[i] : ends[i]].astype(np.float64), path)
        return out

    def _posteriors(self, scores: np.ndarray, path: list[int]) -> list[float]:
        """For each word the probability that its whole span is one, over all labellings of the line (0 outside)."""
        n, move = len(path), self.inner
        forward, backward = np.empty_like(scores), np.zeros_like(scores)
        forward[0] = scores[0] + self.first
        for t in range(1, n):
            forward[t] = _log_sum(forward[t - 1][:, None] + move, 0) + scores[t]
        for t in range(n - 2, -1, -1):
            backward[t] = _log_sum(move + (scores[t + 1] + backward[t + 1])[None, :], 1)
        total, out, t = _log_sum(forward[-1], 0), [0.0] * n, 0
        while t < n:
            start, label = t, path[t]
            t += 1
            if not label:
                continue
            value = forward[start, label]
            while t < n and path[t] == start_inside(path[start]):
                value += move[label, path[t]] + scores[t, path[t]]
                label, t = path[t], t + 1
            if t < n:  # the next word is anything but a further word of the span
                after = move[label] + scores[t] + backward[t]
                after[start_inside(path[start])] = -np.inf
                value += _log_sum(after, 0)
            out[start:t] = [float(np.exp(min(0.0, value - total)))] * (t - start)
        return out

    def _viterbi(self, scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
        """Best paths of lines of similar length, step by step for all of them (arrays are labels x lines)."""
        n, steps, move = len(starts), int(lengths.max()), self.inner.astype(np.float32)
        begin, inside = slice(1, None, 2), slice(2, None, 2)
        best = (scores[starts] + self.first).T.astype(np.float32)
        last = best.copy()
        to_out, to_begin = move[:, 0][:, None], move[:, begin][:, :, None]
        begin_in, in_in = np.diag(move[begin, inside])[:, None], np.diag(move[inside, inside])[:, None]
        from_out = np.zeros((steps, n), dtype=np.int8)  # the label before an outside word
        from_in = np.zeros((steps, len(KINDS), n), dtype=bool)  # whether an inside word follows an inside word
        scored = np.empty((steps, *best.shape), dtype=np.float32)  # for the label before a beginning, on the paths alone
        scored[0] = best
        for t in range(1, steps):
            leave = best + to_out
            from_out[t] = leave.argmax(axis=0)
            after_begin, after_in = best[begin] + begin_in, best[inside] + in_in
            from_in[t] = after_in > after_begin
            new = np.empty_like(best)
            new[0] = leave.max(axis=0)
            new[begin] = (best[:, None] + to_begin).max(axis=0)
            new[inside] = np.maximum(after_begin, after_in)
            best = new + scores[np.minimum(starts + t, len(scores) - 1)].T
            scored[t] = best
            live = t < lengths
            last[:, live] = best[:, live]
        label = last.argmax(axis=0)
        paths = np.zeros((n, steps), dtype=np.int8)
        lines = np.arange(n)
        for t in range(steps - 1, -1, -1):
            live = t < lengths
            paths[:, t] = np.where(live, label, 0)
            kind = np.maximum(label - 1, 0) // 2
            inner = np.where(from_in[t, kind, lines], 2 * kind + 2, 2 * kind + 1)
            before = np.where(label == 0, from_out[t], inner)
            at = np.flatnonzero(live & (label % 2 == 1))
            if t and len(at):
                before[at] = (scored[t - 1][:, at] + move[:, label[at]]).argmax(axis=0)
            label = np.where(live, before, label)
        some = paths.any(axis=1)
        return [paths[i, : lengths[i]].tolist() if some[i] else [] for i in range(n)]


def start_inside(label: int) -> int:
    """The label of further words of a span that begins with ``label``."""
    return label + 1


class _WordClasses(dict):
    """Classes of words, found when first asked for."""

    def __init__(self, field: Crf):
        super().__init__()
        self.field = field

    def __missing__(self, word: str) -> int:
        self[word] = c = self.field.class_of(word)
        return c


def train(rows: Sequence[str]) -> Crf:
    """Fit the field to marked rows (see :func:`parse_row`) by gradient ascent with adapted step sizes."""
    parsed = [p for p in map(parse_row, rows) if p[0]]
    if not parsed:
        raise ValueError("the labelled table is empty")
    cues = _cue_words(parsed)
    classes: dict[tuple[str, ...], int] = {(): 0}  # class 0: beyond the row
    n, steps, k = len(parsed), max(len(w) for w, _ in parsed), len(LABELS)
    own = np.zeros((n, steps + 2), dtype=np.int64)
    gold = np.zeros((n, steps), dtype=np.int64)
    mask = np.zeros((n, steps), dtype=bool)
    for i, (words, labels) in enumerate(parsed):
        for t, (word, label) in enumerate(zip(words, labels, strict=True)):
            own[i, t + 1] = classes.setdefault(tuple(features(word, cues)), len(classes))
            gold[i, t], mask[i, t] = LABELS.index(label), True
    index = {f: i for i, f in enumerate(sorted({f for c in classes for f in c}))}
    has = np.zeros((len(classes), len(index)))
    for feats, c in classes.items():
        has[c, [index[f] for f in feats]] = 1
    views = [own[:, 1:-1], own[:, :-2], own[:, 2:]]
    weights = np.zeros((3, len(index), k))
    moves = np.zeros((k, k))
    squares = [np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)]
    hot = np.eye(k)[gold] * mask[..., None]
    observed = np.zeros((k, k))
    for t in range(1, steps):
        live = mask[:, t]
        np.add.at(observed, (gold[live, t - 1], gold[live, t]), 1)
    for _ in range(STEPS):
        field = Crf(index, weights, moves, cues)
        posterior, expected = _marginals(sum((has @ w)[v] for v, w in zip(views, weights, strict=True)), mask, field)
        rest = (hot - posterior).reshape(-1, k)
        slopes = []
        for v in views:
            per_class = np.zeros((len(classes), k))
            np.add.at(per_class, v.ravel(), rest)
            slopes.append(has.T @ per_class)
        steps_w, steps_m = np.stack(slopes) - PENALTY * weights, observed - expected - PENALTY * moves
        for value, step, square in ((weights, steps_w, squares[0]), (moves, steps_m, squares[1])):
            square += step**2
            value += RATE * step / np.sqrt(square)
    return Crf(index, weights, moves, cues)


def _cue_words(parsed: list[tuple[list[str], list[str]]]) -> frozenset[str]:
    """Outside words of two or more rows with spans that are in no row without any."""
    seen: dict[str, int] = {}
    plain: set[str] = set()
    for words, labels in parsed:
        outer = {w.strip(_EDGE).lower() for w, x in zip(words, labels, strict=True) if x == "O"}
        if all(x == "O" for x in labels):
            plain |= outer
        else:
            for w in outer:
                seen[w] = seen.get(w, 0) + 1
    return frozenset(w for w, c in seen.items() if c >= 2 and w.isalpha() and w not in plain)


def _marginals(e: np.ndarray, mask: np.ndarray, field: Crf) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each word, and expected counts of label pairs, by forward-backward."""
    n, steps, k = e.shape
    forward, backward = np.zeros((n, steps, k)), np.zeros((n, steps, k))
    forward[:, 0] = e[:, 0] + field.first
    for t in range(1, steps):
        new = _log_sum(forward[:, t - 1, :, None] + field.inner, 1) + e[:, t]
        forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
    total = _log_sum(forward[:, -1], 1)
    expected = np.zeros((k, k))
    for t in range(steps - 1, 0, -1):
        live = mask[:, t]
        inner = field.inner + (e[:, t] + backward[:, t])[:, None, :]
        p = np.exp(np.minimum(0, forward[:, t - 1, :, None] + inner - total[:, None, None]))
        expected += (p * live[:, None, None]).sum(axis=0)
        backward[:, t - 1] = np.where(live[:, None], _log_sum(inner, 2), 0.0)
    # beyond a row's end the forward scores stand still and the backward ones are 0
    return np.exp(np.minimum(0, forward + backward - total[:, None, None])) * mask[..., None], expected


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def labelled_rows(table: DataFrame, column: str = "marked") -> list[str]:
    """The marked texts of a small labelled table, at most ``MAX_ROWS`` in text order."""
    return [r[0] for r in table.where(f"{column} IS NOT NULL").select(column).orderBy(column).limit(MAX_ROWS).collect()]


# --- documents ---------------------------------------------------------------


def label_spans(line: str, at: int, path: Sequence[int], sure: Sequence[float]) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end, probability) of a labelled line that starts at code point ``at``, without marks around."""
    found: list[list] = []
    for m, label, score in zip(_WORD.finditer(line), path, sure, strict=True):
        name = LABELS[label]
        if name[0] == "B":
            found.append([name[2:], m.start(), m.end(), score])
        elif name[0] == "I":
            found[-1][2] = m.end()
    out = []
    for kind, a, b, score in found:
        core = line[a:b]
        left, right = len(core) - len(core.lstrip(_EDGE)), len(core.rstrip(_EDGE))
        if right > left and score >= MIN_POSTERIOR:
            out.append((kind, at + a + left, at + a + right, score))
    return out


def find_all(texts: list[str], field: Crf) -> list[tuple[list[Span], list[tuple[str, int, int, float]]]]:
    lines, owner = [], []
    for d, text in enumerate(texts):
        at = 0
        for line in text.split("\n"):
            words = _WORD.findall(line)
            if words:
                lines.append(words)
                owner.append((d, at, line))
            at += len(line) + 1
    found: list[list] = [[] for _ in texts]
    if lines:
        for (d, at, line), labelled in zip(owner, field.decode(lines), strict=True):
            if labelled:
                found[d] += label_spans(line, at, *labelled)
    out = []
    for text, added in zip(texts, found, strict=True):
        base = base_spans(text)
        out.append((base, [s for s in added if outside([s[:3]], base)]))
    return out


def scan(docs: DataFrame, rows: Sequence[str] = LABELLED, text: str = "text", into: str = "found") -> DataFrame:
    """``docs`` with the personal data of each text: array of (kind, start, end, base, score)."""
    field = train(rows)
    shared = docs.sparkSession.sparkContext.broadcast((field.index, field.weights, field.moves, field.cues))

    def make():
        index, weights, moves, cues = shared.value
        memo = process_memo("pii")
        mine = memo.setdefault(hash(weights.tobytes()), Crf(index, weights, moves, cues))
        return lambda texts: find_all(texts, mine)

    return with_spans(docs, make, text, into)


def op1_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(scan(docs).select("doc_id", "found"), BASE_KINDS, KINDS)
