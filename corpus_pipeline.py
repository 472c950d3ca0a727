"""Documents to packed training sequences: each stage works on all that the one before it kept.

Stages take (spark, docs, sf_dir); all but the last return the columns of documents. run() writes each result to the
shared folder and reads it back, so that a lost executor costs part of one stage.
"""

import uuid
from functools import wraps

from pyspark.sql import functions as F

from arborflow.llm import decontaminate, language, line_dedup, near_copies, packing
from arborflow.llm.columns import document_key, without
from arborflow.llm.queries import table, tokenizer_path
from arborflow.session import remove, shared_folder, work_tables, written


BATCH_BYTES = "4m"  # Spark's own limit is 64 MB, and a batch is held several times: by the JVM, its stream, the worker


def small_batches(stage):
    """A stage whose texts go to Python in batches of few bytes, however long they are; results do not depend on it."""

    @wraps(stage)
    def run(spark, docs, sf_dir):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def identify_language(spark, docs, sf_dir):
    """Drops documents that the language model, trained on these documents, rejects: no letters, or hardly any confidence."""
    judged = language.predict(docs, language.fit(docs), prefix="__id_")
    return judged.where(~F.col("__id_rejected")).select(*docs.columns)


def dedup_lines(spark, docs, sf_dir):
    """Takes out runs of two or more lines that stand earlier in the corpus; n_chars follows the text. No document goes."""
    cut = line_dedup.remove_repeated_lines(docs)
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


@small_batches
def dedup_near_copies(spark, docs, sf_dir):
    """Keeps one document of each group of near copies (five-word Jaccard 0.8 or more): that of the smallest id."""
    return near_copies.drop_near_copies(docs)


@small_batches
def decontaminate_documents(spark, docs, sf_dir):
    """Drops the documents that hold a window of a benchmark item, told by id and text: others of the same id stay."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), carried=document_key("doc_id", "text"))
    hit = written(found.where("contaminated").select(F.col("carried").alias("key")).distinct(), "contaminated")
    return without(docs, hit)


@small_batches
def pack_sequences(spark, docs, sf_dir):
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near_copies),
    ("decontamination", decontaminate_documents),
    ("packing", pack_sequences),
]

# The language model, the word hashes of the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The packed sequences. A stage's work tables go once its result is written, and that once the next one's is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/stage-{name}-{uuid.uuid4().hex}"
        with work_tables(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
