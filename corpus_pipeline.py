"""The corpus pipeline: language ID, near-duplicate removal, decontamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet under the shared
checkpoint folder and reads it back as the next stage's ``docs``. All stages but the last return the
columns they were given.

* ``language_id`` judges each half of its input by what the labelled rows of the other teach, and drops rows without a language: no text,
  no letter, or a text of 32 bytes or more that no language codes in under 8 bits a byte.
* ``near_dedup`` keeps one row of each class of near-duplicates, that of the smallest id.
* ``decontamination`` drops rows that the contamination rule names (a twentieth of the words in benchmark passages).
* ``personal_data`` replaces personal data and disclosing terms in ``text``; ``n_chars`` follows.
* ``mixing`` draws documents to the tempered source weights: one row a draw, ordered by (block, place).
"""

from __future__ import annotations

from sentiflow.llm.common import read_table, written
from sentiflow.llm.decontamination import drop_contaminated
from sentiflow.llm.language_id import keep_explained
from sentiflow.llm.mixing import mix
from sentiflow.llm.near_dedup import keep_one_per_class
from sentiflow.llm.pii import sanitise


def language_id(spark, docs, sf_dir):
    return keep_explained(docs)


def near_dedup(spark, docs, sf_dir):
    return keep_one_per_class(docs)


def decontamination(spark, docs, sf_dir):
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    return sanitise(docs, chars_col="n_chars")


def mixing(spark, docs, sf_dir):
    return mix(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

#: Near-duplicates and tempered draws are not for SQL; tests hold ``run`` against a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
