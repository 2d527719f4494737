"""Word counts over a whole corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backlog.llm.common import arrow_map

#: A task sends its counts on when it holds this many words, so its memory doesn't grow with its input.
HELD = 300_000


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents, words in lower case and parted by white space."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update((text or "").lower().split())
                if len(counts) >= HELD:
                    yield {"word": list(counts), "n": list(counts.values())}
                    counts = Counter()
        if counts:
            yield {"word": list(counts), "n": list(counts.values())}

    return arrow_map(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
