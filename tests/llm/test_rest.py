import collections
import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from sensorwatch.llm import brown_lm, chat_format, mixing, quality_rules
from sensorwatch.llm.common import materialize

from .conftest import ROWS

TRICKY = ["", "<|im_end|>", "<", "<\\", "<\\|", "|", "<\\\\|x<", "a\n<|im_start|>assistant\nb", "\\n", "<|part|>", "é漢", "x<\n"]


def test_chat_round_trip(spark):
    rows = [(1, i, ["user", "assistant", "we|ird\n\\role", None][i % 4], t) for i, t in enumerate(TRICKY)]
    rows += [(2, 0, "assistant", None), (2, 0, "assistant", None), (None, None, None, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.format_chats(df.withColumn("parts", chat_format.text_part(F.col("text"))))
    out = out.withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn(
        "said", F.transform("turns", lambda t: chat_format.unescape(t["body"]))
    )
    out = out.withColumn("masked", chat_format.masked_text(F.col("formatted"), F.col("turns"), F.col("loss_spans")))
    got = {r.conv_id: r for r in out.collect()}
    assert got[1].said == TRICKY
    assert [t.role for t in got[1].turns] == [r[2] or "" for r in rows[: len(TRICKY)]]
    assert got[1].masked == "".join(t for i, t in enumerate(TRICKY) if i % 4 == 1)
    for span, t in zip(got[1].loss_spans, TRICKY[1::4], strict=True):
        assert chat_unescape(got[1].formatted[span.start : span.start + span.length]) == t
    assert got[2].n_turns == 2 and got[None].said == ["x"]
    assert chat_format.format_chats(df.limit(0).withColumn("parts", chat_format.text_part(F.col("text")))).count() == 0


def chat_unescape(t):
    import re

    return re.sub(r"<\\(\\*)(\||\Z)", r"<\1\2", t)


def test_typed_parts(spark):
    part = lambda **k: {f: k.get(f) for f in ("type", "text", "ref", "width", "height", "seconds", "pages")}
    rows = [
        (1, 0, "user", [part(type="text", text="a<"), part(type="text", text="|b"), part(type="image", ref="i.png", width=600, height=100)]),
        (1, 1, "assistant", [part(type="audio", ref="s.wav", seconds=2.0), part(type="text", text="ok"), part(type="document", ref="d", pages=3)]),
        (1, 2, "user", [part(type="video", ref="v"), part(type="text")]),
        (1, 3, "user", None),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")
    (r,) = chat_format.format_chats(df).withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn(
        "read", F.transform("turns", lambda t: chat_format.read_parts(t["body"]))
    ).collect()
    assert [(a.number, a.type, a.ref, a.tokens) for a in r.attachments] == [
        (0, "image", "i.png", 2 * 170 + 85), (1, "audio", "s.wav", 50), (2, "document", "d", 1800), (3, "video", "v", 0)
    ]
    assert r.attachment_tokens == 425 + 50 + 1800
    kinds = [[(p.type, p.text, p.number) for p in t if p.type != "text" or p.text] for t in r.read]
    assert kinds[0] == [("text", "a<", None), ("text", "|b", None), ("image", None, 0)]
    assert kinds[1] == [("audio", None, 1), ("text", "ok", None), ("document", None, 2)]
    assert kinds[2] == [("unknown", None, 3)] and r.n_turns == 4


def test_targets_by_brute_force(spark):
    sizes = {"a": 1000, "b": 10, "c": 5, "d": 400, "": 300, None: 7, "zero": 0}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: [1, 2, 3][i % 3] for i, s in enumerate(order)}
    full, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        level = (total - sum(full.values())) / sum(weight[s] for s in rest)
        new = [s for s in rest if weight[s] * level > 3 * sizes[s]]
        if not new:
            break
        full.update({s: 3.0 * sizes[s] for s in new})
    assert got == pytest.approx({s: full.get(s, weight[s] * level) for s in order})


def test_mix_reaches_targets_and_repeats(spark, docs, empty):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), f"s{i % 4}" if i % 3 else "s0") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = ({r._id: (r.source, r.size, r.target, r.copies) for r in mixing.mix(df).collect()} for _ in range(2))
    assert one == two
    taken, target = collections.Counter(), {}
    for s, size, goal, n in one.values():
        assert 0 <= n <= 3
        taken[s] += size * n
        target[s] = goal
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)
    out = mixing.mix_documents(df)
    assert out.columns == df.columns and out.count() == sum(v[3] for v in one.values())
    assert mixing.mix(docs).count() == len(ROWS)
    assert mixing.mix_documents(docs).columns == docs.columns
    assert mixing.mix(empty).count() == 0


def test_lm_base_and_model(spark, docs, empty):
    words = "the a cat dog runs sleeps and red blue".split()
    rows = [(i, " ".join(words[(i * k) % 9] for k in range(1, 12))) for i in range(300)] + [(300, None), (301, "Unseen THE"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in brown_lm.score(df).collect()}
    tok = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows}
    c = collections.Counter(w for i, ws in tok.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tok.items():
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert r.score < 0
    bits = lambda f: sum(f(out[i]) for i, h in held.items() if h)
    assert bits(lambda r: r.score) > bits(lambda r: r.base_score)  # held-out texts are more probable than without classes
    assert brown_lm.score(docs).count() == len(ROWS)
    assert brown_lm.score(empty).count() == 0


def test_exchange_raises_the_likelihood(spark):
    text = " ".join(["the cat sleeps", "a dog runs", "the dog sleeps", "a cat runs"] * 50)
    df = spark.createDataFrame([(2, text), (4, text)], "doc_id long, text string")
    blocked = materialize(brown_lm.blocks(df), "test")
    homes = materialize(brown_lm.word_homes(blocked, 3), "test")
    own, classed, words, tokens = brown_lm.vocabulary(homes)
    assert (len(own), classed, words, tokens) == (6, 6, 6, 2 * 600)
    seq = materialize(brown_lm.sequences(blocked, homes, own), "test")
    classes = brown_lm.first_classes(32)
    counts = brown_lm.neighbours(seq, classes, 32)
    moved = brown_lm.exchange(counts, classes)
    before = brown_lm.likelihood(brown_lm.class_bigrams(counts, classes))
    after = brown_lm.likelihood(brown_lm.class_bigrams(brown_lm.neighbours(seq, moved, 32), moved))
    assert after >= before - 1e-6 and moved[0] == 0 and (moved[1:] > 0).all()


def test_every_word_has_its_own_class(spark, monkeypatch):
    import random

    monkeypatch.setattr(brown_lm, "OWN", 4)  # all other words start in one bucket
    rng = random.Random(5)
    rows = [(i, " ".join(f"{'nv'[k % 2]}{rng.randrange(100)}" for k in range(200))) for i in range(60)]
    out = brown_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    gain = sum(r.score - r.base_score for r in out) / sum(r.n_tokens for r in out)
    assert gain > 0.5 * math.log10(2)  # nouns and verbs take turns: each word is one of a hundred, not of two hundred


def _some_texts():
    import random

    rng = random.Random(3)
    noun, verb = [f"n{i}" for i in range(60)], [f"V{i}" for i in range(40)]
    rows = [(i, " ".join((noun if k % 2 else verb)[int(rng.random() ** 2 * 40)] for k in range(rng.randrange(60)))) for i in range(150)]
    return [*rows, (150, "rare words never seen before n1"), (151, None), (None, "n1 v1")]


def test_lm_score_by_brute_force(spark, monkeypatch):
    """The scores from their definition, with the classes that the operator has found."""
    import numpy as np

    monkeypatch.setattr(brown_lm, "OWN", 8)
    monkeypatch.setattr(brown_lm, "BLOCK_WORDS", 700)
    got, whole = {}, brown_lm.cluster_words

    def watched(texts, homes, own, start, k):
        state, start, bigrams, kept = whole(texts, homes, own, start, k)
        words = {r.home: r.words for r in homes.collect()}
        for r in state.where("home >= 0").collect():
            found = brown_lm._unpack(r.asDict())
            got.update((bytes(words[r.home][p]), int(c)) for p, c in zip(found["places"], found["classes"], strict=True))
        got[None] = k, kept
        return state, start, bigrams, kept

    monkeypatch.setattr(brown_lm, "cluster_words", watched)
    rows = _some_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    out = {r.doc_id: r for r in brown_lm.score(df).collect()}
    k, kept = got.pop(None)
    assert all(y > x for x, y in zip(kept, kept[1:], strict=False)) and len(set(got.values())) > 2
    tok = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    part = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 for i, _ in rows}
    c = collections.Counter(w for i, ws in tok.items() if part[i] for w in ws)
    of = lambda w: 0 if w is None else got.get(w, 1)
    table = {True: np.zeros((k, k)), False: np.zeros((k, k))}
    for i, ws in tok.items():
        for x, y in zip([None, *ws[:-1]], ws, strict=True):
            if part[i]:
                table[part[i] == 1][of(x), of(y)] += 1
    types = np.bincount([of(w) for w in c if w is not None], minlength=k)

    def probability(bigrams, x, y, plain_words):
        """(class model, word's frequency) of the word ``y`` behind the class ``x``."""
        h, n = of(y), bigrams.sum()
        prior = (bigrams[:, h].sum() + 0.1) / (n + 0.1 * k)
        move = (bigrams[x, h] + prior) / (bigrams[x].sum() + 1)
        one = c[y] + 0.1
        plain = (bigrams[:, 0].sum() + 0.1 if y is None else one) / (n + 0.1 * plain_words)
        return move * (1 if y is None else one / (bigrams[:, h].sum() + 0.1 * (types[h] + 1))), plain

    v = len(c)
    fits = np.zeros((k, 100))
    for i, ws in tok.items():
        for x, y in zip([None, *ws[:-1]], ws, strict=True):
            if part[i] == 1:
                a, b = probability(table[False], of(x), y, v + 1)
                one = 1 if y is None else c[y] + 0.1  # leaves the best weight as it is
                fits[of(x)] += [math.log((s * a + (1 - s) * b) / one) for s in np.arange(100) / 100]
    fits += 10 * fits.sum(axis=0) / table[True].sum()
    share = fits.argmax(axis=1) / 100
    both = table[True] + table[False]
    for i, ws in tok.items():
        want = 0.0
        for x, y in zip([None, *ws[:-1]], ws, strict=True):
            a, b = probability(both, of(x), y, v + 1)
            want += math.log10(share[of(x)] * a + (1 - share[of(x)]) * b)
        assert out[i].score == pytest.approx(want), i


def test_lm_reruns_agree_and_leave_only_the_scores(spark, monkeypatch):
    import os

    from sensorwatch.session import checkpoint_root

    monkeypatch.setattr(brown_lm, "OWN", 8)
    monkeypatch.setattr(brown_lm, "BLOCK_WORDS", 300)  # many blocks
    folder = f"{checkpoint_root(spark)}/llm".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    df = materialize(spark.createDataFrame(_some_texts(), "doc_id long, text string").repartition(3, "doc_id"), "test")
    runs, parts = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (parts, "3"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            runs.append({r.doc_id: round(r.score, 6) for r in brown_lm.score(df).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert runs[0] == runs[1]
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert left == {"test", "lm-scores"}


def test_lm_homes_grow_slower_than_blocks(spark, monkeypatch):
    """A sweep packs bytes for each home and block, and weighs each home's words in many groups: homes must have many words."""
    monkeypatch.setattr(brown_lm, "BLOCK_WORDS", 50)
    df = spark.createDataFrame(_some_texts(), "doc_id long, text string").repartition(2, "doc_id")
    blocked = materialize(brown_lm.blocks(df), "test")
    n_blocks, asked, whole = blocked.where("fold IS NULL").count(), [], brown_lm.word_homes

    def watched(given, n):
        asked.append(n)
        return whole(blocked, n)

    monkeypatch.setattr(brown_lm, "word_homes", watched)
    monkeypatch.setattr(brown_lm, "blocks", lambda *_: blocked)
    monkeypatch.setattr(brown_lm, "cluster_words", lambda *_: (_ for _ in ()).throw(InterruptedError))
    with pytest.raises(InterruptedError):
        brown_lm.score(df)
    homes = whole(blocked, asked[0]).select("words", F.explode("routes.block").alias("block")).collect()
    assert n_blocks > 64 and len(homes) <= n_blocks * max(16, n_blocks // 4)  # before: 4 homes for each block
    words = [w for r in whole(blocked, asked[0]).collect() for w in r.words]
    assert len(words) == len(set(words)) > 50  # all words with classes, each at one home
    assert [brown_lm.home_count(n) for n in (0, 1, 4, 64, 112, 6400)] == [1, 4, 16, 16, 28, 1600]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_lm_beats_single_words_on_held_out_texts(spark, sf):
    out = brown_lm.op6_brown_lm(spark, f"/root/testdata/{sf}").where("held_out")
    (row,) = out.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).collect()
    assert row.score > row.base


def test_lm_without_training_documents(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    out = brown_lm.score(spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string")).collect()
    assert len(out) == 3 and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 for r in out)
    assert all(math.isfinite(r.score) for r in out)


def test_moves_change_the_likelihood_as_weighed():
    import numpy as np

    rng, k = np.random.default_rng(0), 32
    ids = np.r_[0, rng.integers(0, 40, 2000) ** 2 // 40, 0]
    classes = np.r_[0, 1 + rng.integers(0, k - 1, 39)]

    def bigrams(of):
        out = np.zeros((k, k))
        np.add.at(out, (of[ids[:-1]], of[ids[1:]]), 1)
        return out

    before, after = ids[:-1], ids[1:]
    for w in set(ids[ids > 0].tolist()):
        counts = np.r_[np.bincount(classes[before[after == w]], minlength=k), np.bincount(classes[after[before == w]], minlength=k)]
        codes = np.flatnonzero(counts)
        own = np.array([float(((before == w) & (after == w)).sum())])
        (gain,) = brown_lm.move_gains(bigrams(classes), classes[[w]], own, np.array([len(codes)]), codes, counts[codes])
        for c in range(1, k):
            moved = classes.copy()
            moved[w] = c
            want = brown_lm.likelihood(bigrams(moved)) - brown_lm.likelihood(bigrams(classes))
            assert gain[c] - gain[classes[w]] == pytest.approx(want, abs=1e-6)


def test_lm_packed_numbers_come_back():
    import numpy as np

    for numbers in ([], [0], [1, 255, 3], [0, 256, 70_000], [5, 1 << 31], [2**40, 7]):
        for dtype in (np.uint8, np.uint32, np.int64):
            if max(numbers, default=0) <= np.iinfo(dtype).max:
                for rising in (False, True):
                    given = np.array(sorted(numbers) if rising else numbers, dtype=dtype)
                    back = brown_lm._loosen(brown_lm._squeeze(given, dtype, rising), dtype, rising)
                    assert back.dtype == dtype and back.tolist() == given.tolist()
    small = np.ones(1000, dtype=np.int64)
    assert brown_lm._squeeze(small, np.int64)[:8] == bytes([1]) + (1000).to_bytes(7, "little")


def test_lm_gains_take_logarithms_once_for_equal_words(monkeypatch):
    import numpy as np

    rng, k, n, taken = np.random.default_rng(1), 32, 3000, 0
    table = rng.integers(0, 500, (k, k)).astype(float)
    whole = brown_lm._phi

    def counted(x):
        nonlocal taken
        taken += np.size(x)
        return whole(x)

    monkeypatch.setattr(brown_lm, "_phi", counted)
    sizes = np.full(n, 6)
    codes = np.concatenate([np.sort(np.r_[rng.choice(k, 3, replace=False), k + rng.choice(k, 3, replace=False)]) for _ in range(n)])
    gain = brown_lm.move_gains(table, rng.integers(1, k, n), np.zeros(n), sizes, codes, rng.integers(1, 4, 6 * n))
    assert gain.shape == (n, k) and taken < 2 * n * k  # once for each neighbour and class would be over 12 times n * k


def test_quality_sketch_and_verdicts(spark, docs, empty):
    clean = [(i, f"line {i} has some plain words in it and goes on for a while, word{i} at the end", "en", f"s{i % 2}") for i in range(400)]
    junk = [(1000 + i, " ".join(f"w{i}{k}###" for k in range(30)), "en", "s0") for i in range(20)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    out = quality_rules.filter_documents(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == list(range(400))
    assert quality_rules.filter_documents(docs).columns == docs.columns
    assert quality_rules.filter_documents(empty).count() == 0


def test_few_documents_are_judged_by_their_own_language(spark):
    english = [(i, f"line {i} has some plain words in it and goes on for a while, word{i} at the end", "en", "s0") for i in range(600)]
    rare = [(1000 + i, " ".join(f"{'ab' * 15}{i}{k}" for k in range(12)), "th", f"s{i % 2}") for i in range(50)]
    df = spark.createDataFrame(english + rare, "doc_id long, text string, lang string, source string")
    assert quality_rules.filter_documents(df).count() == 650


def test_fences_vary_smoothly_with_the_number_of_documents(spark):
    fences = []
    for n in (99, 100):  # a group beside others of its language with longer words
        rows = [("en", "s", i, (100, 500 + i % 7, 0, 0, 0, 1, 0, 0)) for i in range(n)]
        rows += [("en", "t", i, (100, 900 + i % 700, 0, 0, 0, 1, 0, 0)) for i in range(1000)]
        metrics = ",".join(f"{c}:long" for c in quality_rules._COUNTS)
        df = spark.createDataFrame(rows, f"lang string, source string, n long, metrics struct<{metrics}>")
        found = quality_rules.thresholds(quality_rules.sketch(df)).where("source = 's'")
        fences.append(found.first()["max_word_length"])
    assert fences[0] == pytest.approx(fences[1], rel=0.01)


def test_sketch_quantiles_merge(spark):
    values = [(float(i % 97) / 10 + 0.001) for i in range(2000)]
    metrics = spark.createDataFrame(
        [("en" if i % 2 else None, "s", (100, int(v * 1000), 0, 0, 0, 1, 0, 0)) for i, v in enumerate(values)],
        "lang string, source string, metrics struct<" + ",".join(f"{c}:long" for c in quality_rules._COUNTS) + ">",
    )
    merged = quality_rules.merge(quality_rules.sketch(metrics))
    (q,) = quality_rules.quantiles(merged.where("metric = 'word_length'"), [], {"half": 0.5, "q3": 0.75}).collect()
    exact = sorted(int(v * 1000) / 100 for v in values)
    assert q["size"] == 2000
    assert q.half == pytest.approx(exact[999], rel=0.02) and q.q3 == pytest.approx(exact[1499], rel=0.02)


def test_pipeline_on_awkward_rows(spark, docs, empty, tmp_path):
    import corpus_pipeline

    for table in (docs, empty):
        table.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path))
        assert out.columns == ["doc_id", "source", "n_tokens", "round_trip", "ids"]
        assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out.collect())


def test_digest_helper():
    from sensorwatch.llm.spans import sha256

    assert sha256("é") == hashlib.sha256("é".encode()).hexdigest()


def test_pipeline_tokens_hold_one_python_worker_a_task(spark, docs):
    import corpus_pipeline

    out = corpus_pipeline.tokens(spark, docs, "")
    # encoding and decoding in one stage would keep two workers a task, with the memory of encoding in each
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
