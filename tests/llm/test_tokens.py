import random
import zlib

import numpy as np
import public_tokenizers as P
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorwatch.llm import sentencepiece_bpe as spm
from sensorwatch.llm import token_files

from .conftest import ROWS

MODEL, BYTES = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")
ENCODER = spm.Encoder(spm.load_model(MODEL))
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
with open(BYTES, encoding="utf-8") as f:
    WORDS = token_files.TokenEncoder(f.read())
HF = tokenizers.Tokenizer.from_file(BYTES)  # as loaded


def _ids(text):
    return np.frombuffer(ENCODER.encode([text])[0], dtype=np.int32).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab \n▁.,é", max_size=120))
def test_both_encoders_equal_the_libraries(text):
    assert _ids(text) == LIBRARY.encode(text)
    assert ENCODER.decode(_ids(text)) == LIBRARY.decode(LIBRARY.encode(text))
    got = np.frombuffer(WORDS.encode([text], 2)[0], dtype="<u4").tolist()
    assert got == [*HF.encode(text, add_special_tokens=False).ids, 2]


def test_repeats_and_runs():
    rng = random.Random(3)
    for t in [" " * n + x for n in (1, 2, 15, 16, 17, 40) for x in ("", "a")] + ["=" * 99, "ha" * 200, "aaab" * 50]:
        assert _ids(t) == LIBRARY.encode(t)
    for _ in range(200):
        t = "".join(rng.choice("abcab  ") for _ in range(300))
        assert _ids(t) == LIBRARY.encode(t)


def test_encode_and_decode_tables(docs, empty):
    out = spm.decode(spm.encode(docs, MODEL), MODEL)  # replaces the clashing column ids
    assert out.columns == [c for c in docs.columns if c != "ids"] + ["ids", "decoded"]
    for r in out.collect():
        assert r.ids == LIBRARY.encode(r.text or "") and r.decoded == LIBRARY.decode(r.ids)
    assert spm.encode(empty, MODEL).count() == 0


def test_new_words_are_merged_in_bounded_arrays(monkeypatch):
    sizes, whole = [], spm.PairTable.merged

    def watched(self, left, right):
        sizes.append(len(left))
        return whole(self, left, right)

    monkeypatch.setattr(spm.PairTable, "merged", watched)
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdeé漢", k=9)) for _ in range(40_000))
    encoder = spm.Encoder(spm.load_model(MODEL))
    assert np.frombuffer(encoder.encode([text])[0], dtype=np.int32).tolist() == LIBRARY.encode(text)
    assert max(sizes) <= 1 << 17


def test_decode_of_null_empty_and_long_ids(spark):
    ids = [LIBRARY.encode(t) for t in ("a b", "", "é漢 " * 70_000)]
    rows = [(0, None), *[(i + 1, x) for i, x in enumerate(ids * 2)]]
    out = spm.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1), MODEL).collect()
    assert {r.doc_id: r.decoded for r in out} == {i: LIBRARY.decode(x or []) for i, x in rows}


def test_files_round_trip(spark, docs, empty, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_tokens(docs, path, BYTES, end_id=2)
    rows = token_files.with_starts(token_files.read_tokens(spark, path)).collect()
    rows = sorted(rows, key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted((r[0] for r in ROWS), key=lambda i: -1 if i is None else i)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 2
        at += r.n_tokens
    want = sorted(tuple([*HF.encode(t or "", add_special_tokens=False).ids, 2]) for _, t, *_ in ROWS)
    assert sorted(tuple(r.ids) for r in rows) == want
    few = token_files.read_documents(spark, path, [9, 1])
    assert few.count() == 3 and "PushedFilters: [In(doc_id" in few._jdf.queryExecution().toString()
    token_files.write_tokens(empty, str(tmp_path / "none"), BYTES, end_id=2)
    assert token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_control_strings():
    plain = token_files.TokenEncoder(open(BYTES, encoding="utf-8").read(), controls=False)
    text = tokenizers.Tokenizer.from_file(BYTES)
    text.encode_special_tokens = True
    for control in WORDS.added:
        for t in (control, f"a{control}b", f"one two\nthree {control} four. five, six", f"{control}{control} x", f"a {control[:-1]} b"):
            got = np.frombuffer(WORDS.encode(["a b", t, "c."], 2)[1], dtype="<u4").tolist()
            assert got == [*HF.encode(t, add_special_tokens=False).ids, 2]
            got = np.frombuffer(plain.encode([t], 2)[0], dtype="<u4").tolist()
            assert got == [*text.encode(t, add_special_tokens=False).ids, 2]
    assert WORDS.added and 50256 in np.frombuffer(WORDS.encode(["a<|endoftext|>b"], 2)[0], dtype="<u4")


def test_orc_files_have_what_reads_prune_by(spark, docs, tmp_path):
    from pyarrow import orc

    path = tmp_path / "ids"
    token_files.write_tokens(docs, str(path), BYTES, end_id=2)
    files = [orc.ORCFile(str(f)) for f in path.glob("*.orc")]
    assert sum(f.nrows for f in files) == len(ROWS)
    for f in files:
        assert f.compression == "ZSTD" and f.nstripes >= (f.nrows > 0) and f.row_index_stride == 1000


def test_checksum_is_of_little_endian_words():
    data = WORDS.encode(["a b"], 2)[0]
    assert zlib.crc32(data) == zlib.crc32(np.array([*HF.encode("a b").ids, 2], dtype="<u4").tobytes())
