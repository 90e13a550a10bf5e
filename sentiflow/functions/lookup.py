"""Lexicon entries of the words of each row, for a lexicon of any size (SEN-01).

A join of every word with the lexicon shuffles every word. Here the rows are dealt into groups of about ``GROUP_CHARS``
characters, the distinct words of a group are joined with the lexicon (Spark picks the join), and the rows of a group meet
the entries found for it in a cogrouped Arrow function. So a word travels once per group that it occurs in, a text as often as
there are branches (two), and a task holds one group and its entries, however large the lexicon is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters of text that a group of rows holds, about; the groups grow in number with the input.
GROUP_CHARS = 2_000_000


class Entries:
    """The lexicon entries of a group; a token may have several, and a valence may be null."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("token").combine_chunks()
        tokens = table["token"].cast(pa.string()).combine_chunks()
        tokens = (tokens.combine_chunks() if isinstance(tokens, pa.ChunkedArray) else tokens).dictionary_encode()
        self.tokens, self.valences = tokens.dictionary, table["valence"].combine_chunks()
        self.counts = np.bincount(tokens.indices.to_numpy(), minlength=len(self.tokens))
        self.starts = np.cumsum(self.counts) - self.counts

    def find(self, words: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
        """Which of all words are tokens; and per (word, entry): its row, the word's place in the row, the valence."""
        lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        found = pc.index_in(words.flatten(), value_set=self.tokens)
        known = found.is_valid()
        hits, ids = np.flatnonzero(known.to_numpy(zero_copy_only=False)), found.drop_null().to_numpy()
        rows = np.repeat(np.arange(len(lengths)), lengths)[hits]
        places = hits - (np.cumsum(lengths) - lengths)[rows]
        n = self.counts[ids]
        entries = np.repeat(self.starts[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return known, np.repeat(rows, n), np.repeat(places, n), self.valences.take(pa.array(entries))


def lists(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def hits(batch: pa.RecordBatch, entries: Entries) -> dict[str, pa.Array]:
    """``_at`` and ``_valence`` of each (word, entry), in the order of the words; ``_known``: whether each word is a token."""
    words = batch.column("_words")
    known, rows, places, valences = entries.find(words)
    per_row = np.bincount(rows, minlength=len(words))
    return {
        "_at": lists(pa.array(places, pa.int32()), per_row),
        "_valence": lists(valences, per_row),
        "_known": lists(known, pc.list_value_length(words).to_numpy(zero_copy_only=False)),
    }


HITS_DDL = "_at array<int>, _valence array<double>, _known array<boolean>"


def look_up(
    df: DataFrame, words: Callable[[DataFrame], DataFrame], spread: Callable[[DataFrame], DataFrame], lexicon: DataFrame, text_col: str, key: Sequence[str] = (), drop: Sequence[str] = (),
    found: Callable[[pa.RecordBatch, Entries], dict[str, pa.Array]] = hits, found_ddl: str = HITS_DDL, group_chars: int | None = None,
) -> DataFrame:
    """``df`` with what ``words`` adds (``_words``, an array of strings, is looked up) and the columns ``found`` makes of a batch
    and its entries, less the columns ``drop``. ``spread`` makes the distinct (_group, token) of (_group, text) rows.

    ``lexicon``: (token, valence double). ``key``: columns that, with the text, deal the rows into groups; they must be the same when
    ``df`` is computed again. Rows that share key and text share a group.
    """
    chars = df.agg(F.sum(F.length(text_col))).first()[0] or 0
    group = F.pmod(F.xxhash64(F.col(text_col), *key), F.lit(1 + int(chars) // (group_chars or GROUP_CHARS))).alias("_group")
    rows = words(df.select("*", group).repartition("_group"))
    texts = df.select(text_col, group).repartition("_group")
    entries = spread(texts).join(lexicon.select("token", "valence"), "token").select("_group", "token", "valence")
    kept = [f for f in rows.schema.fields if f.name not in ("_group", *drop)]
    names = [f.name for f in kept]
    added = T.StructType.fromDDL(found_ddl)
    schema = T.StructType([*kept, *added.fields])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        known, out = Entries(right), []
        for batch in left.to_batches():
            new = found(batch, known)
            out.append(pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *new.values()], [*names, *new]))
        return pa.Table.from_batches(out) if out else pa.table({c: [] for c in [*names, *added.names]})

    return rows.groupBy("_group").cogroup(entries.groupBy("_group")).applyInArrow(meet, schema)
