"""The registered queries of the subpackage, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medoria.llm import ballcodes, chat, decontaminate, html, langid, neighbours, packing, quality, simhash, spelling, suffixes, topk, urls
from medoria.llm.common import held_out, table


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where(F.col("id") % 50 == 0), vectors, k=5)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ranking = quality.fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return quality.score(docs, ranking).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


#: the rules of the contract: verdict, then host and path
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        sha256(F.array_join(names, ",")).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    out = chat.format_chats(rows.unionByName(probe))
    turns = chat.read_turns(F.col("formatted"))
    read = out.select("conv_id", "formatted", turns.alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256(F.array_join(lines, "")).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        sha256(F.col("loss")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_on_sample(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def tokenizer_files() -> dict[str, str]:
    import public_tokenizers

    return {
        "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def piece_columns(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_columns(packing.pack(table(spark, sf_dir, "documents"), **tokenizer_files()))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(spelling.observed(table(spark, sf_dir, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ballcodes.codes(table(spark, sf_dir, "embeddings"))


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_search": op1_topk_search,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality": op3_quality,
    "op4_simhash": op4_simhash,
    "op5_url_filter": op5_url_filter,
    "op6_decontamination": op6_decontamination,
    "op7_html_text": op7_html_text,
    "op8_chat_format": op8_chat_format,
    "op9_language_id": op9_language_id,
    "op10_packing": op10_packing,
    "op11_neighbours": op11_neighbours,
    "op12_spelling": op12_spelling,
    "op13_vector_codes": op13_vector_codes,
}
