"""Driver queries of the operators, and their SQL twins where SQL can express them.

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from . import codebooks, decontam, htmltext, lines, packing, pii, secretscan, setsketch, sql, suffix, toxicity, warc, whitening
from .common import table
from .ctph import compare_with_next


def tokenizer_path() -> str:
    """The vocabulary file of the packing queries (a parameter of the operator)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.archive_pages(table(spark, sf_dir, "pages"), path)
    return warc.page_index(warc.read_warc(spark, path, verify=True))


def op2_ctph(spark, sf_dir):
    return compare_with_next(table(spark, sf_dir, "documents"))


def op3_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *[pii.count_of(base, kind).alias(f"n_{kind}") for kind in pii.KINDS],
                        F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op4_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.toxicity(docs.select("doc_id", "text"), docs, labels)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_setsketch(spark, sf_dir):
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), setsketch.Settings(shingle=4))


def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), packing.Settings(tokenizer_path()))


def op7_suffix_dedup(spark, sf_dir):
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark, sf_dir):
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_main_text(spark, sf_dir):
    pages = htmltext.with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_secret_ledger(spark, sf_dir):
    ledger = secretscan.Ledger(spark, scratch_path(spark, "secret-ledger"))
    found = secretscan.scan(table(spark, sf_dir, "documents"), ledger, path="doc_id")
    base = F.filter("spans", lambda s: s["rank"] <= len(secretscan.BASE_RULES))
    counts = [F.size(F.filter(F.col("spans.kind"), secretscan.equals(r.kind))).cast("long").alias(f"n_{r.kind}")
              for r in secretscan.BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(secretscan.listed(base), 256).alias("base_sha256"),
                        secretscan.listed(F.col("spans")).alias("spans"))


def op11_line_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return lines.quality(docs.select("doc_id", "text"), docs, labels).select("doc_id", "held_out", "score", "predicted")


def op12_whitening(spark, sf_dir):
    return whitening.whitening(table(spark, sf_dir, "embeddings"))


def op13_codebooks(spark, sf_dir):
    return codebooks.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_ctph": op2_ctph,
    "op3_personal_data": op3_personal_data,
    "op4_toxicity": op4_toxicity,
    "op5_setsketch": op5_setsketch,
    "op6_packing": op6_packing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_main_text": op9_main_text,
    "op10_secret_ledger": op10_secret_ledger,
    "op11_line_quality": op11_line_quality,
    "op12_whitening": op12_whitening,
    "op13_codebooks": op13_codebooks,
}

SQL: dict[str, str] = {
    "op5_setsketch": sql.NEAR_DUPLICATES,
    "op7_suffix_dedup": sql.REPEATS,
    "op1_warc": sql.WARC,
    "op10_secret_ledger": sql.SECRETS,
    "op13_codebooks": sql.CODEBOOKS,
}
