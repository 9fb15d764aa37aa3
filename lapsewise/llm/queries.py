"""The operators of this subpackage over the given tables, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import decontamination, jaccard, language, line_dedup, mixing, periodic, pieces, spelling, token_counts, token_output, toxicity
from lapsewise.llm.store import new_folder, written
from lapsewise.llm.topk import top_k
from lapsewise.llm.urls import filter_urls

#: The rules that the URL query is given.
URL_RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]


#: Tokenizer files of the ``public_tokenizers`` folder, and the id that ends a document.
WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
END_ID = 1


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "entry string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), listed)


def op5_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-ids")
    token_output.write_token_ids(table(spark, sf_dir, "documents"), path, tokenizer_path(WORD_TOKENIZER), END_ID)
    return token_output.read_token_ids(spark, path, ids=False)


def encoded_pieces(docs: DataFrame, *columns: str) -> DataFrame:
    """Digests of each document's ids and of the text that they decode to; other ``columns`` asked for."""
    model = tokenizer_path(PIECE_MODEL)
    ids = pieces.encode(docs, model)
    return pieces.decode(ids, model).select(
        "doc_id",
        *columns,
        (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.length("decoded").cast("bigint").alias("n_chars"),
        F.crc32(F.encode("decoded", "UTF-8")).alias("decoded_crc32"),
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_pieces(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.mark_repeats(table(spark, sf_dir, "documents"))
    return marked.select(
        "doc_id",
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed_lines"),
        F.length("left").cast("bigint").alias("n_chars"),
        F.crc32(F.encode("left", "UTF-8")).alias("text_crc32"),
    )


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = language.fold(F.col("doc_id"), 3)
    model = language.train_model(docs.where(fold != 1))
    held_out = F.coalesce(language.fold(F.col("doc_id"), 3) == 1, F.lit(False))
    # The curve's chances are reported; a text with letters still gets its likeliest language.
    return language.identify(docs, model).withColumn("held_out", held_out)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    """Fitted on the documents whose fold of five is not 0."""
    mine = labels.where(language.fold(F.col("doc_id"), 5) != 0)
    return toxicity.train_model(toxicity.training_sample(docs, mine))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(language.fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def letter_dropped(doc_id: object) -> Callable[[str], str]:
    """op11's misspellings: one in 199 words of a document loses a letter. Without an id, none does."""
    begun = zlib.crc32(f"{doc_id}:".encode())

    def alter(word: str) -> str:
        h = zlib.crc32(word.encode(), begun)
        k = h % len(word)
        return word if h % 199 or doc_id is None else word[:k] + word[k + 1 :]

    return alter


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), change=letter_dropped)
    return spelling.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


#: The curriculum. The schedules' integrals are the weights 5, 2 and 1.
SCHEDULES = (
    mixing.Schedule(((0.0, 7.0), (1.0, 3.0))),
    mixing.Schedule(((0.0, 2.0), (1.0, 2.0))),
    mixing.Schedule(((0.0, 0.5), (0.5, 0.5), (1.0, 2.5))),
)


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, order = mixing.mix(table(spark, sf_dir, "documents"), SCHEDULES)
    order = written(order, "training-order")
    # What the written order holds of each document, and 0 for those that it doesn't hold.
    digest = ["doc_id", "size", "source_size", "target"]
    rows = plan.select("source_no", "place", *digest, F.lit(0).cast("bigint").alias("words"))
    empty = [F.lit(None).cast(plan.schema[c].dataType).alias(c) for c in digest]
    rows = rows.unionAll(order.select("source_no", "place", *empty, F.col("size").alias("words")))
    firsts = [F.max(c).alias(c) for c in digest]
    return rows.groupBy("source_no", "place").agg(*firsts, F.sum("words").alias("taken")).select(*digest, "taken")


def repeating_tail(doc_id: object, n: int) -> np.ndarray | None:
    """Which words op13 takes of a document's n: every tenth document's tail repeats its beginning."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return at


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.mark_runs(table(spark, sf_dir, "documents"), pick=repeating_tail)
    first = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", 0),
        lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", first).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col("longest")[name].alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * longest.length DIV longest.period").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (op1_token_counts, op2_benchmark_decontamination, op3_ngram_jaccard, op4_url_filters, op5_token_id_output, op6_sentencepiece, op7_line_dedup, op8_exact_top_k, op9_language_id, op10_toxicity, op11_spelling_variants, op12_mixing, op13_periodic_runs)
}
