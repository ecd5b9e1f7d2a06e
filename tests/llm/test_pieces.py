"""Piece encoding against the library, and small vocabularies against a plain loop."""

import hashlib
import random

import cases
import pytest

from tagweave.llm import pieces, queries

MODEL = queries.tokenizer_path("piece_bpe_32k.model")
PARTS = [*"ab c  \n\t\0é中😀▁<>0x4", "the ", "ing", "́", "ééé", "  ", " and", "�"]


def texts(seed=1):
    rng = random.Random(seed)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 150))) for _ in range(80)]
    return [*made, None, "", " ", "   ", "a", "▁", "<s>", "<0x41>", "</s>[INST]", "x" * 3000,
            " " * 700, "ab" * 2000, "é" * 500, "😀" * 60, "word " * 5000, made[0], made[0]]


def frame(spark, rows):
    names = "doc_id long, text string, IDS string, decoded string, row string, given int"
    return spark.createDataFrame([(i, t, "a", "b", "c", 4) for i, t in enumerate(rows)],
                                 names).repartition(3)


def test_ids_and_texts_are_the_library_s(spark):
    given = texts()
    coded = pieces.decode_texts(pieces.encode_texts(frame(spark, given), MODEL), MODEL)
    library = pieces.vocabulary(MODEL).library
    both = pieces.encode_texts(frame(spark, given), MODEL, keep=["doc_id"], decoded="Decoded")
    assert both.columns == ["doc_id", "ids", "Decoded"]
    assert {tuple(map(str, r)) for r in both.collect()} == {
        tuple(map(str, r)) for r in coded.select("doc_id", "ids", "decoded").collect()}
    rows = coded.collect()
    assert len(rows) == len(given)
    for r in rows:
        right = library.encode(given[r["doc_id"]] or "")
        assert r["ids"] == right and r["decoded"] == library.decode(right)
        assert (r["row"], r["given"]) == ("c", 4)
    assert coded.columns == ["doc_id", "text", "row", "given", "ids", "decoded"]


def test_an_empty_table_and_null_ids(spark):
    assert pieces.encode_texts(frame(spark, texts()).limit(0), MODEL).collect() == []
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [tuple(r) for r in pieces.decode_texts(none, MODEL).collect()] == [(1, None, "")]


def test_malformed_text_becomes_replacement_characters(spark):
    bad = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    ids = pieces.encode_texts(bad, MODEL).first()["ids"]
    assert ids == pieces.vocabulary(MODEL).library.encode("a�b")


def test_the_heap_and_the_columns_agree(monkeypatch):
    held = pieces.vocabulary(MODEL)
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(1, 40)))
             for _ in range(300)]
    data = "".join(" " + w for w in words).encode()
    import numpy as np
    counts = np.array([len(w) + 1 for w in words])
    side = pieces.encode_segments(held, data, counts)
    monkeypatch.setattr(pieces, "SHORT", 5)
    mixed = pieces.encode_segments(held, data, counts)
    assert side[0].tolist() == mixed[0].tolist() and side[1].tolist() == mixed[1].tolist()


def test_a_difference_raises():
    import numpy as np
    held = pieces.vocabulary(MODEL)
    ids = held.library.encode("hello")
    lengths = np.array([6])
    pieces.refuse_difference(held, b" hello", lengths, np.array(ids, np.int32),
                             np.array([len(ids)]))
    with pytest.raises(ValueError, match="otherwise"):
        pieces.refuse_difference(held, b" hello", lengths, np.array([*ids[:-1], 5], np.int32),
                                 np.array([len(ids)]))


def test_hashes_that_meet_change_nothing(monkeypatch):
    import numpy as np
    held = pieces.vocabulary(MODEL)
    text = (" " + " ".join(f"w{i % 7}" for i in range(50))).encode()
    data, rows = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    right = pieces.encode_rows(held, data, rows)[0].tolist()
    monkeypatch.setattr(pieces, "span_hashes", lambda d, s, e: np.zeros(len(s), np.uint64))
    assert pieces.encode_rows(held, data, rows)[0].tolist() == right


def test_the_query_over_a_whole_table(spark, tmp_path):
    rows = cases.documents()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    library = pieces.vocabulary(MODEL).library
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    right = []
    for i, t in (r[:2] for r in rows):
        ids = library.encode(t or "")
        right.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    found = queries.op12_piece_agenda(spark, str(tmp_path)).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, right))
