"""Rows for the corpus operators' tests: odd rows that every operator must take, and texts with planted cases."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words string, doc string, bucket int, term int, "\
    "_text string, _hit int, _items string, _words int, _row int, _bits string, _id int, _hash int, row int, bits int, id string, text_hash string, lang_pred int"


def frame(spark, rows):
    """(doc_id, text, lang, source) rows as documents, with further columns whose names clash with the operators' own."""
    full = [(d, t, la, s, None if t is None else len(t), "x", None, "y", 1, 2, "a", 3, "b", 4, 5, "c", 6, 7, 8, 9, "d", "e", 10) for d, t, la, s in rows]
    return spark.createDataFrame(full, COLUMNS)


def prose(seed, words=60, letters="abcdefghij", sizes=(2, 9)):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(words))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows and repeated ids."""
    long_text = prose(99, 20_000)
    return [
        (1, prose(1), "en", "a"),
        (1, prose(1), "en", "a"),
        (1, prose(2), "en", "a"),
        (2, None, "en", None),
        (3, "", None, "a"),
        (4, " \t\n", "en", "b"),
        (None, prose(3), None, None),
        (None, None, None, None),
        (5, long_text, "en", "b"),
        (6, "!!! 123 ###", "en", "b"),
        (7, "é ñ ü 漢字 🙂 word", "de", "b"),
        (8, "one", "de", "c"),
    ]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
