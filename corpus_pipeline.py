"""A corpus pipeline of five stages, each written as Parquet and read again by the next one.

Defined results: documents without letters (null and empty texts among them), and those whose language
isn't recognised, go in the first stage; without any declared language no document is recognised. Rows
that are repeated, or share an id, are documents of their own: one of each group of near-duplicates
stays, by its least id and text (a null id last). A null id passes through all stages. Texts of any
length are handled whole. Further columns are kept up to the last stage, whatever their names; that one
returns the columns of the packing. An empty table gives an empty result.
"""

from pyspark.sql import functions as F

from tickerloom.llm import decontamination, language_id, packing, pii, simhash
from tickerloom.llm.queries import tokenizer_file
from tickerloom.sources.stages import staged


def known_languages(spark, docs, sf_dir):
    """Documents whose language is recognised; the rejected ones go."""
    return language_id.accepted(docs, host=F.col("source"))


def one_of_each_group(spark, docs, sf_dir):
    """One document of each group of SimHash near-duplicates."""
    return simhash.group_representatives(docs)


def without_benchmarks(spark, docs, sf_dir):
    """Documents in which no benchmark window occurs."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark, docs, sf_dir):
    """All documents, personal data masked."""
    return pii.redact(docs)


def packed(spark, docs, sf_dir):
    """The pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("language_id", known_languages),
    ("simhash", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("pii", without_personal_data),
    ("packing", packed),
]

# The fitted language model, XXH64 and the tokenizer are not SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
