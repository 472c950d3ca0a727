"""Registered queries: each applies one operator to its whole table."""

from pyspark.sql import functions as F

from arborflow.llm import collocations, decontaminate, embedding_dedup, html_text, language, licenses, line_dedup, packing, periodic_runs, secret_scan, simhash, substring_dedup, vector_tree
from arborflow.llm.columns import let


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_html_text(spark, folder):
    found = html_text.extract(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_license_scan(spark, folder):
    found = licenses.scan(table(spark, folder, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")}).drop("n_found")


def op3_harmonic_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


def op4_simhash_near_dedup(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op5_line_dedup(spark, folder):
    found = line_dedup.remove_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_chunks", "n_removed_lines", kept)


def op6_embedding_near_dedup(spark, folder):
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op7_secret_scan(spark, folder):
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = secret_scan.listed(F.filter("spans", lambda s: s["kind"] != "random"))
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(base, 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"))


def op8_winnowing_decontamination(spark, folder):
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items, "contaminated")


def op9_substring_dedup(spark, folder):
    return substring_dedup.remove_repeats(table(spark, folder, "documents")).drop("removed")


def op10_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.select("doc_id", F.coalesce(language.fold_of("doc_id") == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op11_phrase_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


def op12_vector_search(spark, folder):
    return vector_tree.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def planted_runs(text, doc_id):
    """The text of one document in ten with a period planted in its tail, by its id alone; the others as they are."""
    h = F.crc32(F.encode(doc_id.cast("string"), "utf-8"))
    g = F.floor(h / 10)

    def planted(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p))), " ")).otherwise("")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    return F.when(h % 10 == 0, let(words, planted)).otherwise(text)


def op13_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", planted_runs(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs.find_runs(docs)
    best = lambda r: F.struct(-r["length"], r["start"], r["period"])
    top = F.get(F.array_sort(F.transform("runs", best)), 0)
    found = found.withColumn("best", F.struct((-top["col1"]).alias("length"), top["start"].alias("start"), top["period"].alias("period")))
    listed = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {f.__name__: f for f in (op1_html_text, op2_license_scan, op3_harmonic_packing, op4_simhash_near_dedup, op5_line_dedup, op6_embedding_near_dedup, op7_secret_scan, op8_winnowing_decontamination, op9_substring_dedup, op10_language_id, op11_phrase_collocations, op12_vector_search, op13_periodic_runs)}
