import random
import re

import numpy as np

from sensorwatch.llm import pii_crf, pii_labelled, secret_scan
from sensorwatch.llm.spans import digests

from .conftest import ROWS

FIELD = pii_crf.train(pii_labelled.LABELLED)
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _personal(t):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, least, most in (("card", CARD, 12, 19), ("phone", PHONE, 9, 15)):
        for m in pattern.finditer(t):
            d = re.sub("[^0-9]", "", m[0])
            if least <= len(d) <= most and (kind == "phone" or _luhn(d)):
                out.append((kind, m.start(), m.end()))
    return sorted(out)


def _secrets(t):
    assign = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
    out = [("assign", m.start(), m.end()) for m in assign.finditer(t) if len(m[1]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return sorted(out + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


def _noise(rng):
    alphabets = ["ab.@-1%", "12.3456789.", "+1 ()-234567890.", "4111 -", "0123.255.256 ", "é漢a@b.c1"]
    words = ["password", "API_key", "token", "=", ": ", "'", '"', "AKIA", "0af", "0123456789abcdef", "Zz09+/", " ", "\n"]
    if rng.random() < 0.5:
        return "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(80)))
    return "".join(rng.choice(words) for _ in range(rng.randrange(20)))


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(7)
    for _ in range(20000):
        t = _noise(rng)
        assert sorted(pii_crf.base_spans(t)) == _personal(t)
        assert sorted(secret_scan.base_spans(t)) == _secrets(t)


def test_long_runs_take_linear_time():
    for t in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "password" * 20_000, "a=b" * 70_000, "token=" + " " * 200_000):
        pii_crf.base_spans(t)
        secret_scan.find_secrets(t)


def test_field_on_held_out_rows():
    rows = [
        ("my name is Olga Petrova", "Olga Petrova", "name"), ("Dear Mr. Black, thanks", "Black", "name"),
        ("ssn: 111-22-3333", "111-22-3333", "id"), ("SSN 321-54-9876 was seen", "321-54-9876", "id"),
        ("phone: (333) 555-0100", None, "phone"), ("Phone 333-555-0100 today", "333-555-0100", "phone"),
        ("email me: rosa (at) example (dot) org today", None, "email"), ("Tel: 040 555 0142 77 work", None, "phone"),
    ]
    hits = 0
    for text, want, kind in rows:
        ((_, added),) = pii_crf.find_all([text], FIELD)
        hits += any(k == kind and (want is None or text[a:b] == want) for k, a, b, _ in added)
    assert hits >= 7
    plain = [r for r in pii_labelled.plain_rows(100, seed=99)]
    flagged = sum(bool(added) for _, added in pii_crf.find_all(plain, FIELD))
    assert flagged <= 3


def test_adjacent_items_are_told_apart():
    rows = [
        ("Name: John Miller, 555-0143-221", [("name", "John Miller"), ("phone", "555-0143-221")]),
        ("Mrs. Eva Klein eva (at) example (dot) org", [("name", "Eva Klein"), ("email", "eva (at) example (dot) org")]),
        ("Patient name: Anna Black, 987-65-4320", [("name", "Anna Black"), ("id", "987-65-4320")]),
        ("ssn: 111-22-3333, 212-555-0121", [("id", "111-22-3333"), ("phone", "212-555-0121")]),
    ]
    for text, want in rows:
        ((base, added),) = pii_crf.find_all([text], FIELD)
        got = sorted([(a, k, text[a:b]) for k, a, b, _ in added] + [(a, k, text[a:b]) for k, a, b in base])
        assert [g[1:] for g in got] == want
    at = {x: i for i, x in enumerate(pii_crf.LABELS)}
    assert FIELD.inner[at["I-name"], at["B-phone"]] > -100 and FIELD.inner[at["B-id"], at["B-id"]] > -100
    assert FIELD.inner[at["B-name"], at["I-phone"]] < -1000


def test_training_rows_are_learned():
    wrong = 0
    for row in pii_labelled.LABELLED:
        words, labels = pii_crf.parse_row(row)
        (got,) = FIELD.decode([words])
        wrong += ([pii_crf.LABELS[x] for x in got[0]] if got else ["O"] * len(words)) != labels
    assert wrong <= 8


def test_viterbi_equals_all_paths():
    import itertools

    words = "Mr. Black 555".split()
    scores, _ = FIELD.emissions([words])
    best = max(
        itertools.product(range(len(pii_crf.LABELS)), repeat=3),
        key=lambda p: FIELD.first[p[0]] + sum(scores[t, p[t]] for t in range(3)) + sum(FIELD.inner[p[t], p[t + 1]] for t in range(2)),
    )
    got = FIELD._viterbi(scores, *map(__import__("numpy").array, ([0], [3])))[0] or [0, 0, 0]
    assert tuple(got) == best


def test_constants_reach_sensitive_names():
    found = lambda t: [t[a:b] for _, a, b, _ in secret_scan.find_secrets(t)[1]]
    assert found('a = "x9Kd83jsLm20"; db_pwd = a') == ["x9Kd83jsLm20"]
    assert found('p1 = "abcD1234"\nsecret_key = p1 + "zzQ99__x"') == ["abcD1234", "zzQ99__x"]
    assert found('host = "x9Kd83jsLm20"\ncount = host') == []
    assert found("private_key: changeme\ntoken_file = '/etc/abc123XY'") == []
    assert found('k = "Q7w8E9r0T1y2"\nurl = "pre"\nauth_token = "${k}"') == ["Q7w8E9r0T1y2"]


def test_constants_of_many_parts():
    import time

    rng = random.Random(3)
    parts = ["".join(rng.choices("ABCDEFabcdef0123456789+/", k=40)) + "a1B" for _ in range(60)]
    found = lambda t: [t[a:b] for _, a, b, _ in secret_scan.find_secrets(t)[1]]
    assert found("".join(f'pem += "{x}"\n' for x in parts) + "private_key = pem") == parts
    assert found('pem = "' + '" + "'.join(parts) + '"\nblob = pem + pem\nprivate_key = blob') == parts
    start = time.time()
    assert found('a = "x9Kd83jsLm20"\n' + "a = a + a\n" * 20_000 + "db_pwd = a") == ["x9Kd83jsLm20"]
    found("".join(f'a += "{x}"\nb = a\ndb_pwd = b\n' for x in parts * 100))
    assert time.time() - start < 20


def test_tables(docs, empty):
    for scan, base, kinds in ((pii_crf.scan, pii_crf.BASE_KINDS, pii_crf.KINDS), (secret_scan.scan, secret_scan.KINDS[:3], secret_scan.KINDS)):
        found = scan(docs)
        assert found.columns == [*docs.columns, "found"] and found.count() == len(ROWS)
        assert digests(found, base, kinds).count() == len(ROWS)
        assert scan(empty).count() == 0


def test_repeated_words_and_long_lines_are_no_personal_data():
    field = pii_crf.train(pii_crf.LABELLED)
    texts = [
        "Orre " * 300, "antion " * 4000, "Orre antion " * 500 + "\n" + "der hund und die katze " * 400,
        "My name is the house and " + "lina " * 200, "mail it to " + "the old town hall " * 300, "Versa " * 3,
        "x" * 5000 + " " + "Ab" * 3000 + " # " + "*" * 900,
    ]
    for text, (base, added) in zip(texts, pii_crf.find_all(texts, field), strict=True):
        assert (base, added) == ([], []), text[:40]
    adjacent = "Name: John Miller, 555-0143-221\nMrs. Eva Klein eva (at) example (dot) org"
    [(_, added)] = pii_crf.find_all([adjacent], field)
    assert [(k, adjacent[a:b]) for k, a, b, _ in added] == [
        ("name", "John Miller"), ("phone", "555-0143-221"), ("name", "Eva Klein"), ("email", "eva (at) example (dot) org"),
    ]
    assert all(pii_crf.MIN_POSTERIOR <= s <= 1 for *_, s in added)


def test_span_probabilities_equal_enumeration():
    from itertools import product

    field = pii_crf.train(pii_crf.LABELLED[:40])
    line = "call Eva Klein now".split()
    scores, _ = field.emissions([line])
    scores = scores.astype(float)

    def weight(p):
        return field.first[p[0]] + sum(scores[t, x] for t, x in enumerate(p)) + sum(field.inner[a, b] for a, b in zip(p, p[1:]))

    b = pii_crf.LABELS.index("B-name")
    paths = list(product(range(len(pii_crf.LABELS)), repeat=len(line)))
    values = np.exp([weight(p) for p in paths])
    want = sum(v for p, v in zip(paths, values) if p[1] == b and p[2] == b + 1 and p[3] != b + 1) / values.sum()
    got = field._posteriors(scores, [0, b, b + 1, 0])
    assert got[0] == got[3] == 0 and abs(got[1] - want) < 1e-9 and got[1] == got[2]
