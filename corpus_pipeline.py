"""The corpus pipeline: quality, repeated lines, near duplicates, test passages, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.llm import byte_bpe, decontaminate, line_dedup, near_dup, quality_mil
from tabloom.llm.common import table
from tabloom.llm.queries import byte_tokenizer
from tabloom.session import new_path, scratch, written

#: Characters of a chunk of texts in the last stage: a fraction of the operator's own, as its workers share memory with the heap after all stages.
CHUNK_CHARS = 5_000_000
#: Words of a shard that is searched for test passages, for the same reason.
SHARD_WORDS = 300_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the passage classifier rejects go. Null and empty texts are scored as empty ones, texts of any length from all their passages,
    repeated rows alike; an empty table gives an empty one."""
    model = quality_mil.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_mil.score_quality(docs, model).filter("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document that loses all its words with them goes, too. Null and empty texts have no lines and stay; repeated rows
    share their decisions; an empty table gives an empty one."""
    done = line_dedup.dedup_lines(docs)
    return _documents(done.filter((F.col("n_exact") + F.col("n_near") == 0) | F.col("text").rlike(line_dedup.SOLID)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least id. Null and empty texts are one text, of which one row stays,
    as of rows that repeat; an empty table gives an empty one."""
    return near_dup.keep_first(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from the others the few hit words are cut out. Null and empty texts have no words and stay; an empty table, or an
    empty test set, changes nothing."""
    found = decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark"), shard_words=SHARD_WORDS)
    # stored before the cut: an executor keeps as many Python workers as its tasks have ever used at once, here one a task and not two
    left = written(found.filter(~decontaminate.contaminated()).select(*COLUMNS, "spans"), "overlaps")
    return _documents(decontaminate.cut_spans(left))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a digest of what they decode to. Null and empty texts have no ids; repeated rows are encoded alike; an empty
    table gives an empty one."""
    ranks, pattern = byte_tokenizer()
    # stored in between for the same reason
    both = byte_bpe.decode(written(byte_bpe.encode(docs, ranks, pattern, chunk_chars=CHUNK_CHARS), "ids"), ranks)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: The classifier learns by gradient steps, which SQL cannot repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as kept:
        for name, stage in STAGES:
            # what a stage has stored on its way goes when its rows are written, the rows of earlier stages at the end
            with scratch(spark) as of_stage:
                path = new_path(spark, name.replace(" ", "-"))
                stage(spark, docs, sf_dir).write.parquet(path)
                of_stage.append(path)
            docs = spark.read.parquet(path)
        kept.append(path)
    return docs
