"""Token counts by the whole-token shortcut.

Once for a vocabulary, every string that stands in it is proven to encode alone as one token or not. Pre-tokens of a
text that are among the proven strings count one by a table lookup; only the rest are merged, and a word's count is kept
for its next occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import SPACE, Vocabulary, plain_words, pre_tokens, vocabulary
from tidemark.llm.common import arrow_schema, rows_of, texts


def proven_words(pieces: Vocabulary) -> dict[str, int]:
    """The vocabulary's words, without their space mark, that encode alone as exactly one token: each maps to 1."""
    return {p[1:]: 1 for p in pieces.ids if p[0] == SPACE and len(p) > 1 and pieces.encode(p) == [pieces.ids[p]]}


class WordCounts(dict):
    """Tokens of a space mark followed by a word. Starts as the proven table; other words are merged when first met.

    At ``limit`` entries it starts anew from the table, and words of over 64 characters are not kept, so its memory is
    bounded; that changes the time alone.
    """

    def __init__(self, pieces: Vocabulary, limit: int = 500_000):
        self.pieces, self.limit = pieces, limit
        self.proven = proven_words(pieces)
        super().__init__(self.proven)

    def __missing__(self, word: str) -> int:
        n = len(self.pieces.encode(SPACE + word))
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
                self.update(self.proven)
            self[word] = n
        return n

    def count(self, text: str) -> int:
        found = plain_words(text)
        if found is not None:
            return sum(map(self.__getitem__, found))
        return sum(self[p[1:]] if p[0] == SPACE else len(self.pieces.encode(p)) for p in pre_tokens(text))


@lru_cache(maxsize=2)
def word_counts(path: str) -> WordCounts:
    return WordCounts(vocabulary(path))


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, n_bytes (UTF-8) and n_tokens, without begin or end tokens.

    Null and empty texts have zero bytes and tokens. Ids may be null or repeated; rows stay as they are. Other columns
    are left out. Nothing is shuffled; a task holds one slice of texts and the word table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(model_path)
        for ids, values in rows_of(batches):
            n_bytes = pc.cast(pc.binary_length(pa.array(values, pa.large_string())), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), n_bytes, pa.array([counts.count(t) for t in values], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    chosen = texts(docs, id_col, text_col)
    id_type = arrow_schema(chosen.schema).field("doc_id").type
    id_sql = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {id_sql}, n_bytes long, n_tokens long")


def with_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
