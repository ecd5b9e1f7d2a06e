"""Registered queries over whole small tables, and the pipeline, against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import cases
import corpus_pipeline
from tagweave.llm import ann, ppm, queries
from tagweave.llm.queries import tokenizer_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.fixture(scope="module")
def corpus():
    """Documents whose ids are all different, with every awkward trait."""
    rng = random.Random(21)
    rows = cases.documents(7)
    passage = cases.prose(rng, 14, 5000)
    rows += [(300 + i, cases.prose(rng, 30, 3000) + " " + passage + " " + cases.prose(rng, 9))
             for i in range(3)]
    body = cases.prose(rng, 90, 3000)
    rows += [(400 + i, body.replace(" ", "  ") if i == 2 else body + " end" * (i % 2))
             for i in range(6)]
    return rows, [(1, passage), (2, "nowhere " * 12), (3, None)]


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, items = corpus
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS).repartition(
        3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    # One class only: nothing to tell toxic documents by.
    spark.createDataFrame([(i, 1, 0) for i, _ in rows[:40]], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{folder}/labels.parquet")
    return folder


def ids_of(texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")).encode_batch(
        texts, add_special_tokens=False)
    return [[*x.ids, 2] for x in found]


def check_pieces(found, rows):
    """Pieces cover each document's ids once, and sequences without gaps."""
    right = dict(zip((i for i, _ in rows), ids_of([t or "" for _, t in rows])))
    at, sequences = Counter(), defaultdict(list)
    for r in sorted(found, key=lambda r: (r["doc_id"], r["start"])):
        ids = right[r["doc_id"]]
        part = ids[r["start"]:r["start"] + r["length"]]
        assert r["start"] == at[r["doc_id"]] and r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        at[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert at == {i: len(x) for i, x in right.items()}
    for held in sequences.values():
        end = 0
        for offset, n in sorted(held):
            assert offset == end
            end += n
        assert end <= 4096


def test_packing_query(spark, folder, corpus):
    check_pieces(queries.op2_vector_packing(spark, folder).collect(), corpus[0])


def test_repeats_query(spark, folder, corpus):
    found = queries.op5_suffix_repeats(spark, folder).collect()
    assert {tuple(r) for r in found} == {
        (i, n, gone, spans, sha(kept)) for i, n, gone, spans, kept in cases.removed_bytes(corpus[0])}


def plain_ppm(train, texts, order=ppm.ORDER):
    """log10 probability of texts by counts of dictionaries, context by context."""
    end, symbols = ppm.END, ppm.SYMBOLS

    def stream(text):
        return [*" ".join(cases.words(text)).encode(), end]

    # Of the longest contexts every occurrence counts, of shorter ones each longer one that
    # was seen, of the two shortest every occurrence.
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for text in train:
        held = [end] * order + stream(text)
        for k in range(order, len(held)):
            for j in (0, 1, order):
                counts[j][tuple(held[k - j:k])][held[k]] += 1
    for j in range(order - 1, 1, -1):
        for context, seen in counts[j + 1].items():
            for symbol in seen:
                counts[j][context[1:]][symbol] += 1
    never = symbols - len(counts[0][()])
    known = {}

    def length(context, symbol):
        if (context, symbol) not in known:
            total, gone = 0.0, set()
            for j in range(order, -1, -1):
                here = counts[j].get(context[order - j:], {})
                rest = {s: n for s, n in here.items() if s not in gone}
                if symbol in rest:
                    total += math.log10((2 * rest[symbol] - 1) / (2 * sum(rest.values())))
                    break
                if rest:
                    total += math.log10(len(rest) / (2 * sum(rest.values())))
                gone = set(here) or gone
            else:
                total -= math.log10(max(1, never))
            known[context, symbol] = total
        return known[context, symbol]

    out = []
    for text in texts:
        held = [end] * order + stream(text)
        out.append(sum(length(tuple(held[k - order:k]), held[k]) for k in range(order, len(held))))
    return out


@pytest.mark.parametrize("size", [ppm.BUCKET_BYTES, 3000])
def test_score_query(spark, folder, corpus, monkeypatch, size):
    monkeypatch.setattr(ppm, "BUCKET_BYTES", size)
    rows = corpus[0]
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    right = dict(zip((i for i, _ in rows), plain_ppm(train, [t for _, t in rows])))
    tokens = Counter(w for t in train for w in cases.words(t))
    tokens["</end>"] = len(train)
    n = sum(tokens.values())
    for r in queries.op6_ppm_scores(spark, folder).collect():
        text = dict(rows)[r["doc_id"]]
        said = [*cases.words(text), "</end>"]
        assert r["train_tokens"] == n and r["n_tokens"] == len(said)
        assert r["n_known"] == sum(w in tokens for w in said)
        assert r["base_score"] == pytest.approx(sum(math.log10(
            (tokens[w] + 1) / (n + len(tokens) + 1)) for w in said))
        assert r["score"] == pytest.approx(right[r["doc_id"]], rel=1e-4, abs=1e-4)


def test_neighbours_query(spark, tmp_path):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(800, 24)).astype(np.float32)
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(m)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    scores = m.astype(float) @ m.astype(float).T
    found = defaultdict(list)
    for r in queries.op9_inverted_multi_index(spark, str(tmp_path)).collect():
        assert r["score"] == pytest.approx(scores[r["query_id"], r["vec_id"]])
        found[r["query_id"]].append((r["rank"], r["vec_id"]))
    hits = 0
    for q in range(0, 800, 20):
        best = [j for j in np.argsort(-scores[q], kind="stable") if j != q][:20]
        assert [rank for rank, _ in sorted(found[q])] == list(range(1, 21))
        hits += len(set(best) & {j for _, j in found[q]})
    assert hits >= 0.9 * 20 * 40 and ann.VISIT < 1


def test_chat_query(spark, tmp_path):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["system", "user", "assistant"]), rng.choice(
        [None, "", "[INST] </s>", cases.prose(rng, 25)])) for c in range(9) for t in range(c * 5 + 1)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(
        2).write.parquet(f"{tmp_path}/conversations.parquet")
    said = "</s>[INST] ok [/INST]"
    talks = defaultdict(list)
    for c, t, role, text in [*sorted(rows, key=lambda r: r[:2]), (-1, 0, "user", said),
                             (-1, 1, "assistant", said)]:
        talks[c].append((role, text or ""))
    found = queries.op1_chat_windows(spark, str(tmp_path)).collect()
    assert {r["conv_id"] for r in found} == set(talks)
    for r in found:
        turns = talks[r["conv_id"]]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (
            len(turns), sha("".join(f"{role}\n{t}\n" for role, t in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))


def test_pipeline_equals_plain_stages(spark, folder, corpus):
    from test_texts import benchmark_hits

    rows, items = corpus
    rows = [(i, t) for i, _, _, t in cases.dropped_lines(rows)]
    groups = cases.near_components(rows, 5)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    hit = {i for i, _, n, _ in benchmark_hits(rows, items, 10) if n}
    kept = [(i, t) for i, t in rows if i not in hit]
    assert len(corpus[0]) > len(rows) > len(kept) > 30
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in found} == {i for i, _ in kept}
    check_pieces(found, kept)
