"""The corpus pipeline: from raw documents to tokens, one operator after the other.

Each stage gets the documents that the one before it kept, written as Parquet and read again. All but the last return the
columns they get, whatever their names; helper columns take names that are free. An empty table gives an empty result.
Nulls, empty and long texts, ties and repeated rows have the results each stage states.
"""

import public_tokenizers

from grabqc.llm import bpe, decontam, quality, simhash, suffix
from grabqc.llm.common import keep, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def reject_low_quality(spark, docs, sf_dir):
    """Documents that the classifier, trained on the labels, takes for bad go.

    A null text is judged as an empty one. A null id is judged like any; repeated rows are judged each, and alike. Labels without an id or a
    value teach nothing; without any labels every document stays.
    """
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark, docs, sf_dir):
    """Of each group of near copies the document with the smallest id stays.

    Null and empty texts are one group. A null id counts as larger than any other; of rows that tie for the smallest id of
    a group, one stays. Rows that share an id but are no near copies stay.
    """
    return simhash.drop_near_duplicates(docs)


def cut_repeated_passages(spark, docs, sf_dir):
    """Passages that an earlier document holds too are cut out; every document stays.

    A null text stays null, and a text that is cut whole is empty; ``n_chars`` follows. Rows that share an id, or have none, do not cut
    each other; a null id counts as larger than any other.
    """
    return suffix.drop_repeats(docs)


def drop_benchmark_leaks(spark, docs, sf_dir):
    """Documents that hold a benchmark item, or one within the edit distance, go.

    Null and empty texts hold nothing, null and empty items are held by nothing; repeated rows and null ids are judged each. Without
    items every document stays.
    """
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark, docs, sf_dir):
    """Number and digests of each document's tokens.

    A null text is an empty one, with no tokens; null ids stay null and repeated rows have a row each.
    """
    return bpe.digests(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", reject_low_quality),
    ("near-duplicates", drop_near_copies),
    ("repeated passages", cut_repeated_passages),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("byte-level BPE", tokenize),
]

#: Learnt scores, hashed fingerprints and BPE merges have no equivalent in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, from the documents table."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = keep(docs, f"stage-{number}")
    return docs
