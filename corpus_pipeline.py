"""From raw documents to packed sequences: stages of ``barmill.llm``, one after the other.

Every stage takes any rows: null, empty and very long texts, null and repeated ids, rows that are repeated
as a whole, other columns of whatever name (which all but the last keep), and no rows at all. What each does
with them stands with it.
"""

from __future__ import annotations

from barmill.llm.common import table, written
from barmill.llm.exact_dedup import drop_exact_duplicates
from barmill.llm.near_dedup import drop_near_duplicates
from barmill.llm.packing import packed_pieces
from barmill.llm.personal_data import sanitised
from barmill.llm.toxicity import drop_toxic, train


def not_toxic(spark, docs, sf_dir):
    """Documents that the classifier, fitted on the labelled ones, does not call toxic.

    Rows are judged one by one by their whole text; a null text as an empty one, which stays. Without labels
    to learn from all stay.
    """
    return drop_toxic(docs, train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def exact_once(spark, docs, sf_dir):
    """One document of each group of texts that are equal but for blanks: the longest, of ties that of the least id.

    A null id is larger than all others. Null, empty and blank texts are one group. Of rows that repeat id and
    text one stays.
    """
    return drop_exact_duplicates(docs)


def near_once(spark, docs, sf_dir):
    """The document of the least id of each group that is linked by near-duplicates.

    Texts without words, null ones among them, and rows without an id are linked with nothing and stay. Rows
    that share an id stay or go together.
    """
    return drop_near_duplicates(docs)


def without_personal_data(spark, docs, sf_dir):
    """All documents, with personal data and what gives it away replaced.

    As many rows as before; a null text stays null. Repeated rows are replaced alike.
    """
    return sanitised(docs)


def packed(spark, docs, sf_dir):
    """Pieces of documents in token sequences.

    A null or empty text is its end mark alone. Repeated rows are packed each, under the same id.
    """
    return packed_pieces(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("exact_dedup", exact_once),
    ("near_dedup", near_once),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

# SQL has no tokenizer, classifier or near-duplicate search; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = written(docs, name)
    return docs
