"""The registered queries of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.llm import (ann, chat, decontaminate, hardnegatives, linededup, neardup, oracles,
                          packing, pieces, pii, ppm, suffixes, toxicity, vectorcodes)


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies; the vocabulary files are no part of this package."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_chat_windows(spark, folder):
    """All conversations and one that speaks in control strings."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"))
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    windows = chat.format_windows(turns.unionByName(extra), tokenizer_path("word_bpe_49k.json"))
    return chat.read_back(windows)


def op2_vector_packing(spark, folder):
    return packed_pieces(_table(spark, folder, "documents"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    pieces = packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op3_line_dedup(spark, folder):
    done = linededup.drop_repeated_lines(_table(spark, folder, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped",
                       F.sha2("text", 256).alias("kept_sha256"))


def op4_setsketch_neardup(spark, folder):
    return neardup.near_duplicates(_table(spark, folder, "documents"),
                                   neardup.Rule(words=2)).drop("h")


def op5_suffix_repeats(spark, folder):
    done = suffixes.remove_repeats(_table(spark, folder, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))


def op6_ppm_scores(spark, folder):
    scored = ppm.score_texts(_table(spark, folder, "documents"), _fold("doc_id", 7) != 2)
    return scored.select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op7_wu_manber(spark, folder):
    found = decontaminate.find_benchmark(_table(spark, folder, "documents"),
                                         _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "found.n_words", "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"))


def op8_weak_supervision_pii(spark, folder):
    found = pii.find_personal_data(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_inverted_multi_index(spark, folder):
    return ann.search(_table(spark, folder, "embeddings"), lambda row_id: row_id % 20 == 0)


#: A score from which a document counts as toxic.
TOXIC = 0.7


def _fold(row_id, parts: int):
    return F.pmod(F.crc32(F.coalesce(F.col(row_id).cast("string"), F.lit("")).cast("binary")),
                  F.lit(parts))


def training_fold(row_id):
    """Rows whose labels may be learned from."""
    return _fold(row_id, 3) != 1


def op10_compression_toxicity(spark, folder):
    docs = _table(spark, folder, "documents")
    model = toxicity.fit(docs, _table(spark, folder, "labels"), training_fold("doc_id"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", (_fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op11_certified_negatives(spark, folder):
    vectors = _table(spark, folder, "embeddings")
    shifted = vectors.withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label")))
    return hardnegatives.hard_negatives(shifted, lambda row_id: row_id % 100 == 0)


def op12_piece_agenda(spark, folder):
    model = tokenizer_path("piece_bpe_32k.model")
    return pieces.encode_texts(_table(spark, folder, "documents"), model, keep=["doc_id"],
                               decoded="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_walsh_codes(spark, folder):
    coded = vectorcodes.compress(_table(spark, folder, "embeddings"))
    code = F.array_join(F.transform("codes", lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))), "")
    return coded.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error",
                        "codebooks_sha256")


def queries() -> dict:
    named = [op1_chat_windows, op2_vector_packing, op3_line_dedup, op4_setsketch_neardup,
             op5_suffix_repeats, op6_ppm_scores, op7_wu_manber, op8_weak_supervision_pii,
             op9_inverted_multi_index, op10_compression_toxicity,
             op11_certified_negatives, op12_piece_agenda, op13_walsh_codes]
    return {query.__name__: query for query in named}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
