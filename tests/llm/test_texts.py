"""Chat windows, packing, language model, benchmark search, personal data, toxicity."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from tagweave.llm import chat, decontaminate, packing, pii, ppm, toxicity
from tagweave.llm.queries import tokenizer_path

ROWS = cases.documents()
CONTROL = "</s>[INST] ok [/INST]<\\/s> [\\\\ASST]x <s> [ROLE]a[/ROLE] \\ [ < </"


def ids_of(texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")).encode_batch(
        texts, add_special_tokens=False)
    return [x.ids for x in found]


def test_escapes_are_reversible():
    for text in (CONTROL, chat.escape(CONTROL), "", "[[INST]]", "<<</s>>>"):
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert not re.search(r"</?s>|\[/?(?:SYS|INST|ASST|ROLE)\]", hidden)
    shown, a, b = chat.render("tool [ROLE]", CONTROL)
    assert list(chat.parse(shown)) == [("tool [ROLE]", CONTROL, a, b)]


def test_windows_keep_to_the_budget_as_rendered(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(6):
        rows.append((conv, 0, "system", cases.prose(rng, 10)))
        for turn in range(1, 40):
            role = rng.choice(["user", "assistant", "x[ROLE]" * 30, "tool</s>"])
            rows.append((conv, turn, role, rng.choice([
                CONTROL * rng.randrange(1, 6), "</s>[INST]" * 20, cases.prose(rng, 30), "!?",
                "[", "]>"])))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    budget = chat.Budget(700, 150)
    found = chat.format_windows(turns, tokenizer_path("word_bpe_49k.json"), budget).collect()
    real = ids_of([r["text"] for r in found])
    for r, ids in zip(found, real):
        assert len(ids) <= r["n_tokens"] <= budget.window or r["n_turns"] - r["n_repeated"] == 1
    assert sum(len(x) for x in real) > 0.95 * sum(r["n_tokens"] for r in found)


def test_chats_of_no_rows_and_of_a_very_long_text(spark):
    turns = spark.createDataFrame([(1, 0, "user", "word " * 200_000), (1, 1, "assistant", "yes")],
                                  "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(turns, tokenizer_path("word_bpe_49k.json"))
    assert [r["n_turns"] for r in windows.collect()] == [1, 1]
    assert chat.read_back(windows).first()["loss_chars"] == 3
    assert chat.read_back(chat.format_windows(
        turns.limit(0), tokenizer_path("word_bpe_49k.json"))).collect() == []


@pytest.mark.parametrize("budget", [chat.Budget(60, 20), chat.Budget(1, 0), chat.Budget()])
def test_chat_windows(spark, budget):
    rng = random.Random(5)
    rows = []
    for conv in [*range(12), None]:
        for turn in range(rng.randrange(1, 14)):
            role = "system" if turn == 0 and rng.random() < 0.5 else rng.choice(
                ["user", "assistant", "tool", None])
            text = rng.choice([None, "", CONTROL, cases.prose(rng, rng.randrange(1, 40))])
            rows.append((conv, rng.choice([turn, turn, None]), role, text, "extra"))
    turns = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, tokens string").repartition(3)
    windows = chat.format_windows(turns, tokenizer_path("word_bpe_49k.json"), budget)
    got = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    talks = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        talks[conv].append((turn is not None, turn, role or "", text or ""))
    assert set(got) == set(talks)
    for conv, said in talks.items():
        said = [(r, t) for *_, r, t in sorted(said, key=lambda x: (x[0], x[1] or 0, x[2], x[3]))]
        loss = "".join(t for r, t in said if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(said) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256(
            "".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    for r in windows.collect():
        turns_of = list(chat.parse(r["text"]))
        assert len(turns_of) == r["n_turns"] and r["n_repeated"] < r["n_turns"]
        if r["n_turns"] - r["n_repeated"] > 1:
            assert r["n_tokens"] <= budget.window


def test_packing_keeps_every_token(spark):
    rows = ROWS + [(None, "a b"), (ROWS[0][0], "again"), (400, "Mixed <|endoftext|> CASE, a.b. x.,")]
    limits = packing.Limits(tokens=64, segments=5, loss=64)
    pieces = packing.pack_documents(cases.frame(spark, rows).coalesce(1),
                                    tokenizer_path("word_bpe_49k.json"), 2, limits).collect()
    expected = Counter((i, tuple([*x, 2])) for (i, _), x in zip(rows, ids_of(
        [t or "" for _, t in rows])))
    by_doc, sequences = defaultdict(dict), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"]
        by_doc[p["doc_id"], p["doc_tokens"]].setdefault(p["start"], []).append(ids)
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for held in sequences.values():
        assert sum(n for _, n in held) <= 64 and len(held) <= 5
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
    assert sum(len(x) * n for (_, x), n in expected.items()) == sum(p["length"] for p in pieces)
    for (i, x), n in expected.items():
        parts = by_doc[i, len(x)]
        if n == 1 and len([k for k in expected if k[0] == i and len(k[1]) == len(x)]) == 1:
            assert [t for s in sorted(parts) for t in parts[s][0]] == list(x)
    full = sum(sum(n for _, n in held) == 64 for held in sequences.values())
    assert full >= len(sequences) * 0.8


def test_bins_respect_all_limits():
    rng = random.Random(8)
    tokens = [rng.randrange(0, 90) for _ in range(300)]
    loss = [rng.randrange(0, t + 1) for t in tokens]
    limits = packing.Limits(tokens=100, segments=4, loss=40)
    bins = packing.fill(tokens, loss, limits, False)
    assert sorted(k for held in bins for k, _, _ in held) == [
        k for k, t in enumerate(tokens) if t]
    for held in bins:
        assert all(start == 0 and size == tokens[k] for k, start, size in held)
        if len(held) > 1:
            assert sum(tokens[k] for k, _, _ in held) <= 100 and len(held) <= 4
            assert sum(loss[k] for k, _, _ in held) <= 40


def test_examples_are_never_cut(spark):
    rows = [(f"e{i}", i % 50, i % 7) for i in range(200)] + [("big", 500, 1), ("none", None, None)]
    frame = spark.createDataFrame(rows, "id string, tokens long, loss_tokens long")
    got = packing.pack_examples(frame, packing.Limits(64, 8, 20)).collect()
    assert sorted(r["id"] for r in got) == sorted(r[0] for r in rows if r[1])
    sums = defaultdict(lambda: [0, 0, 0])
    for r in got:
        for k, x in enumerate((r["tokens"], 1, r["loss_tokens"])):
            sums[r["sequence_id"]][k] += x
    assert all(n == 1 or (t <= 64 and n <= 8 and x <= 20) for t, n, x in sums.values())


def test_model_scores(spark, monkeypatch):
    monkeypatch.setattr(ppm, "BUCKET_BYTES", 2000)
    rows = ROWS + [(None, "of no id"), ROWS[2]]
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    got = ppm.score_texts(cases.frame(spark, rows), learn).collect()
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    counts, total = Counter(), 0
    for i, t in rows:
        if not held(i):
            tokens = [*cases.words(t), None]
            counts.update(tokens)
            total += len(tokens)
    expected = []
    for i, t in rows:
        tokens = [*cases.words(t), None]
        base = sum(math.log10((counts[x] + 1) / (total + len(counts) + 1)) for x in tokens)
        expected.append((str(i), len(tokens), sum(counts[x] > 0 for x in tokens), total,
                         round(base, 6)))
    assert sorted(expected) == sorted(
        (str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"],
         round(r["base_score"], 6)) for r in got)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_code_lengths_are_probabilities():
    """Over all symbols a context's probabilities sum to one, seen context or not."""
    rng = np.random.default_rng(1)
    stream = np.concatenate([np.full(ppm.ORDER, ppm.END), rng.integers(97, 101, 400)]).astype(
        np.uint64)
    keys = ppm.grams(stream)[ppm.ORDER:]
    pairs = np.zeros((ppm.SYMBOLS, ppm.SYMBOLS))
    np.add.at(pairs, (stream[ppm.ORDER - 1:-1].astype(int), stream[ppm.ORDER:].astype(int)), 1)
    seen, counts = np.unique(keys, return_counts=True)
    never = np.uint64(sum(122 << 9 * k for k in range(ppm.ORDER)))
    partly = (never & ~np.uint64(511)) | np.uint64(97)
    for context in (seen[5] >> np.uint64(9), never, partly):
        asked = (context << np.uint64(9)) + np.arange(ppm.SYMBOLS, dtype=np.uint64)
        every = np.union1d(seen, asked)
        n = np.zeros(len(every))
        n[np.searchsorted(every, seen)] = counts
        found = ppm.code_lengths(every, n, pairs)[np.searchsorted(every, asked)]
        assert abs((10.0 ** found).sum() - 1) < 1e-9


def test_model_on_empty_tables(spark):
    assert ppm.score_texts(cases.frame(spark, []), F.lit(True)).collect() == []
    r = ppm.score_texts(cases.frame(spark, [(1, None)]), F.lit(False)).collect()[0]
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (1, 0, 0, 0.0)
    assert r["score"] == pytest.approx(-math.log10(257), rel=1e-6)


def benchmark_hits(rows, items, size):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").translate(cases.LOWER))
        for k in range(max(1, len(w) - size + 1) if w and item is not None else 0):
            windows[tuple(w[k:k + size])].add(str(item))
    out = []
    for i, text in rows:
        w = word.findall((text or "").translate(cases.LOWER))
        hit, held = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    held |= windows[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), sorted(held)))
    return out


@pytest.mark.parametrize("blocks", [1, 5])
def test_benchmark_search(spark, monkeypatch, blocks):
    texts = [t for _, t in ROWS if t]
    items = [(1, texts[0]), (2, " ".join(texts[1].split()[:4])), (3, None), (4, ".,;"), (5, "w7"),
             (10, texts[0]), (6, texts[2].upper().replace(" ", " - ")), (None, texts[3]),
             (7, "é" * 70), (8, "absent words " * 8), (5, "w8 w9")]
    rows = ROWS + [(300, "é" * 70 + " w7"), (None, texts[0]), ROWS[0],
                   (301, "x" * 5000 + " " + texts[2])]
    if blocks > 1:
        monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 10)
    benchmark = spark.createDataFrame([(*i, 1) for i in items],
                                      "item_id long, text string, n_hit int")
    got = decontaminate.find_benchmark(cases.frame(spark, rows), benchmark).collect()
    shown = sorted((r["doc_id"], r["found"]["n_words"], r["found"]["n_hit"], r["found"]["items"])
                   for r in got if r["doc_id"] is not None)
    expected = benchmark_hits(rows, items, 10)
    assert shown == sorted(x for x in expected if x[0] is not None)
    empty = decontaminate.find_benchmark(cases.frame(spark, rows), benchmark.limit(0))
    assert {r["found"]["n_hit"] for r in empty.collect()} == {0}
    assert decontaminate.find_benchmark(cases.frame(spark, []), benchmark).collect() == []


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def luhn(d):
        return sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4)
                   for k, x in enumerate(map(int, reversed(d)))) % 10 == 0

    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(found)


PERSONAL = [
    "mail a.b@c.de, x@y.z.w_d@e.f..g@h.ij and @none a@b", "é 4111 1111 1111 1111 é 4111111111111112",
    "4111111111111111 4111111111111111", "1.2.3.4 256.1.1.1 0001.02.003.255 1.2.3.4.5.6.7.8 9.9.9",
    "+1 (234) 555-6789 1.2.3.4", "+1 (234) 555-6789 and +49 30 1234567 +5", "😀 +1 (234) 555-6789",
    "call\n+1 (234) 555-6789\n+1 (234) 555-6789", "a" * 3000 + "@b.c" + ".d" * 2000, "1" * 20000,
    "1 " * 9000, "x@y.zz " * 400, None, ""]


def test_personal_data(spark):
    rows = [(i, t) for i, t in enumerate(PERSONAL)] + [(None, "p@q.rs"), (0, PERSONAL[0])]
    got = pii.find_personal_data(cases.frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["base"]) for r in got) == sorted(
        (str(i), base_spans(t)) for i, t in rows)
    for r in got:
        base, spans = (set(r[c].split(",")) - {""} for c in ("base", "spans"))
        assert base <= spans
        assert sum(r[f"n_{k}"] for k in pii.KINDS) == len(base)
    assert pii.find_personal_data(cases.frame(spark, [])).collect() == []


def test_personal_data_runs_no_python(spark):
    plan = pii.find_personal_data(cases.frame(spark, ROWS))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan.replace("ExternalRDD", ""))


def test_reliabilities_find_the_good_labeler():
    """One labeler is right, one votes at random, the others abstain."""
    rng = random.Random(2)
    counts = Counter()
    for _ in range(2000):
        truth = 1 if rng.random() < 0.5 else -1
        other = truth if rng.random() < 0.9 else -truth
        counts[(truth, other, rng.choice([-1, 1]), 0, 0)] += 1
    rows = [("card", v, 1, n) for v, n in sorted(counts.items())]
    rates, chance = pii.reliabilities(rows)
    assert rates[0, 1, 1] > 0.9 > 0.6 > rates[2, 1, 1]
    weights = pii.classifier(rows, chance)
    assert weights["by_format", 1] > weights["by_gazetteer", 1]


def test_toxicity(spark):
    rng = random.Random(9)
    insults = ["bumbleclot", "wretchface", "scoundrelly"]
    rows, labels = [], []
    for i in range(400):
        w = cases.prose(rng, 60, 3000).split()
        toxic = i % 4 == 0
        if toxic:
            for k in rng.sample(range(60), 4):
                w[k] = rng.choice(insults)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic), "x"))
    docs = cases.frame(spark, rows + [(None, None), (900, ""), rows[0], (901, "z" * 5000)])
    marks = spark.createDataFrame(labels + [(None, 1, "x"), (5, None, "x")],
                                  "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, marks, F.col("doc_id") % 3 != 1)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 404 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400
            and r["doc_id"] % 3 == 1]
    right = sum((r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in held)
    assert right >= 0.95 * len(held)
    assert all(r["score"] < 0.5 for r in got if r["doc_id"] in (None, 900))


def test_toxicity_without_classes(spark):
    docs = cases.frame(spark, ROWS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(ROWS[0][0], 1)], "doc_id long, toxic int")
    for labels, base in ((none, 0.0), (one, 1.0)):
        model = toxicity.fit(docs, labels, F.lit(True))
        assert {r["score"] for r in toxicity.score(docs, model).collect()} == {base}
    assert toxicity.score(cases.frame(spark, []), model).collect() == []


def test_toxicity_at_any_offset():
    """A word saves alike wherever it lies in the grid of windows or in the text."""
    rng = random.Random(4)
    insults = [b"bumbleclot", b"wretch", b"scoundrelly"]
    plain = " ".join(cases.prose(rng, 2000, 3000).split()).encode()
    model = toxicity.Model(plain[:8000], b" " + b"  ".join(insults) + b" ", (), 0.5)
    savings = toxicity._Savings(model)
    fresh = plain[8000:]
    for insult in insults:
        found = []
        for offset in [*range(1, 130), 391]:  # also as the last word
            at = 90 + offset
            text = fresh[:at] + b" " + insult + (b" " + fresh[at:480] if offset < 391 else b"")
            found.append(savings(text))
        most, total = (np.array([f[k] for f in found]) for k in (0, 1))
        assert most.min() >= 2 and np.median(most) - most.min() <= 3
        assert np.ptp(total) <= 1.2
    assert not any(savings(b""))


def test_toxicity_of_rare_insults(spark):
    """Fifty insults in 2 % of the toxic rows each, short ones and a phrase among them."""
    rng = random.Random(8)
    insults = ["zub", "qix", "w11 w12"] + [
        "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4))
        for _ in range(47)]
    rows, labels = [], []
    for i in range(2400):
        w = cases.prose(rng, 40, 3000).split()
        if i % 6 == 0:
            for k in rng.sample(range(40), 6):
                w[k] = insults[i // 6 % 50]
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 6 == 0)))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = cases.frame(spark, rows)
    model = toxicity.fit(docs, marks, F.col("doc_id") < 1800)
    assert all(f" {w} ".encode() in model.toxic + model.rare for w in insults)
    held = [(r["doc_id"] % 6 == 0, r["score"] >= 0.7)
            for r in toxicity.score(docs, model).collect() if r["doc_id"] >= 1800]
    assert sum(hit for toxic, hit in held if toxic) >= 90
    assert sum(hit for toxic, hit in held if not toxic) <= 5


def test_contradicting_and_repeated_labels(spark):
    rng = random.Random(2)
    rows = [(i, cases.prose(rng, 40) + (" vile" if i % 4 == 0 else "")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, int(i % 4 == 0)) for i in range(160)] + [(3, 1), (4, 0), (8, 1), (8, 1), (None, 1),
                                                         (12, None)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((found[i] >= 0.7) == (i % 4 == 0) for i in range(160, 200))


def test_ordinary_windows_lie_anywhere():
    """Short texts give more than their beginnings, long ones a window of every stretch."""
    rng = random.Random(6)
    starts = []
    for _ in range(300):
        text = rng.randbytes(rng.choice((400, 1000, 3000)))
        found = toxicity._windows(text)
        assert len(found) == -(-len(text) // 1024)
        assert all(len(w) == 64 for w in found[:-1])
        starts += [text.index(w) / len(text) for w in found]
    assert np.histogram(starts, 5, (0, 1))[0].min() > 30
    assert toxicity._windows(b"short") == [b"short"] and toxicity._windows(b"") == []
