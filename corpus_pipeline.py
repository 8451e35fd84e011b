"""From raw documents to packed sequences: the stages of a training corpus, one after the other.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written and read again before the next one. All but the last
return the columns of the documents they were given; their decisions take effect:

1. ``language``: documents whose language cannot be told (no text, no letter) go.
2. ``near_duplicates``: of every group of documents whose five-word shingles are similar
   (0.8 or more) the one with the smallest id stays.
3. ``repeats``: strings of 200 bytes that stand in two places are cut out of the texts.
4. ``contamination``: documents that hold a passage of the benchmark go.
5. ``packing``: the texts become pieces of token sequences.

Null, empty and repeated rows take part like any other; a document without an id is
told apart by its text. Of rows with one id and one text the near-duplicate stage keeps one,
chosen by a hash of all their columns. Texts of any length are taken whole; ties go to the
smaller id. Columns beside those of the documents stay, whatever their names. Empty
tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medoria.llm import decontaminate, langid, packing, similar_sets, suffixes
from medoria.llm.common import held_out, table
from medoria.llm.queries import piece_columns, tokenizer_files
from medoria.work import materialise

WORDS = 5
SIMILAR = (4, 5)
# of 256 bits of SimHash about 39 differ at that similarity (48 for sets of 4 and 5 shingles), of the first 64 about
# 10 (12). The bounds for candidates lie over three deviations above the latter, over four above the former
RADIUS = (22, 70)

NO_ID = (1 << 63) - 1


def _row(docs: DataFrame) -> Column:
    """All columns of a document, as one."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, text, key): the key tells documents apart, by the id (none sorts last) and a hash of the text; never null."""
    key = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("text"))
    return docs.select(_row(docs).alias("row"), "text", key.alias("key"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit_on_sample(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = langid.identify(docs.select(_row(docs).alias("row"), "text"), model, id="row")
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    groups = similar_sets.similar_groups(keyed.select("key", "text"), WORDS, SIMILAR, RADIUS, id="key")
    stay = groups.where(F.col("key") == F.col("component_id")).select("key").distinct()
    kept = keyed.join(stay, "key", "left_semi")
    # of rows with one id and text any of the equal ones, else always the same
    return kept.groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = docs.select(*(f"`{c}`" for c in docs.columns if c not in ("text", "n_chars")))
    cut = suffixes.remove_repeats(docs.select(_row(rest).alias("row"), "text"), id="row", whole_characters=True)
    out = cut.select("row.*", F.decode("kept", "UTF-8").alias("text"))
    out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*(f"`{c}`" for c in docs.columns))


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    found = decontaminate.contamination(keyed.select("key", "text"), table(spark, sf_dir, "benchmark"), id="key")
    hit = found.where(F.size("spans") > 0).select("key").distinct()
    return keyed.join(hit, "key", "left_anti").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_columns(packing.pack(docs, **tokenizer_files()))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("contamination", contamination),
    ("packing", pack),
]

# SQL expresses neither the tokenizer nor the language model. tests/llm/test_stages.py has the stages that are tested
# against brute force with the parameters they run with
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
