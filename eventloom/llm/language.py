"""Language ID by compression: one raw-content zstandard dictionary a language.

A text is compressed once with each language's dictionary; the language with the smallest
result is predicted, and a narrow margin to the second marks the prediction as unreliable.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import extended

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Dictionary contents by language, in the order that decides ties."""

    contents: dict[str, bytes]
    chunk_chars: int = 4096
    level: int = 9
    min_margin: float = 0.01


def letters_only(text: Column) -> Column:
    """Lower-cased runs of letters with one blank between them: what is learned and compared."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " "))


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    slices: int = 64,
    slice_chars: int = 1024,
    max_languages: int = 256,
    **settings,
) -> LanguageModel:
    """Dictionaries from a bounded sample: ``slices`` slices of ``slice_chars`` characters a language.

    Distinct texts are counted and drawn, by their hash, so copies fill no place of another text;
    each slice begins at a place in the text that the hash gives. Rows without language or
    letters are left out. Of more than ``max_languages`` languages those with the most
    distinct texts are learned. No rows: an empty model, which
    answers ``und``.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    h = F.xxhash64("text")
    distinct = rows.select("lang", h.alias("h")).distinct()  # copies go before any row is moved
    counts = distinct.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages)
    # About four times the wanted texts are left before any is moved.
    near = (F.pmod(h, F.lit(1_000_000)) < F.lit(4e6) * slices / F.col("count")) | (F.col("count") <= 4 * slices)
    start = F.pmod(F.shiftright(h, 20), F.greatest(F.length("text") - slice_chars, F.lit(1))).cast("int") + 1
    drawn = (
        rows.join(F.broadcast(counts), "lang")  # max_languages rows
        .where(near)
        .select("lang", h.alias("h"), letters_only(F.substring("text", start, F.lit(slice_chars))).alias("slice"))
        .groupBy("lang", "h")
        .agg(F.min("slice").alias("slice"))
    )
    first = Window.partitionBy("lang").orderBy("h", "slice")
    picked = (
        drawn.withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= slices)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("n", "slice"))).alias("slices"))
        .collect()  # slices * slice_chars characters a language
    )
    contents = {
        row["lang"]: " ".join(x["slice"] for x in row["slices"]).encode()
        for row in sorted(picked, key=lambda r: r["lang"])
    }
    return LanguageModel(contents, **settings)


class Classifier:
    """The model with its compressors, made once in each Python worker."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.parts = []
        for lang, content in model.contents.items():
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=model.level)
            self.parts.append(
                (lang, zstandard.ZstdCompressor(dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False))
            )

    def predict(self, letters: str) -> tuple[str, float, bool]:
        """Language, score (0 to 1: how much smaller than the second) and whether it is reliable."""
        if not self.parts or not letters:
            return UNDETERMINED, 0.0, False
        step = self.model.chunk_chars
        chunks = [letters[i : i + step].encode() for i in range(0, len(letters), step)]
        sizes = sorted((sum(len(c.compress(x)) for x in chunks), k) for k, (_, c) in enumerate(self.parts))
        best = self.parts[sizes[0][1]][0]
        if len(sizes) == 1:
            return best, 1.0, True
        score = 1.0 - sizes[0][0] / sizes[1][0]
        return best, score, score >= self.model.min_margin


def predict(documents: DataFrame, model: LanguageModel, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """``keep``'s columns with lang_pred, score and reliable for every row.

    Null texts and texts without a letter are ``und`` with score 0. Equal sizes go to the
    language that comes first by name. Long texts are compressed whole, in chunks.
    """
    kept = documents.select(*[c.alias(n) for n, c in keep.items()], letters_only(F.col(text_col)).alias("_text"))
    schema = extended(kept, "lang_pred string, score double, reliable boolean", ("_text",))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            out = [classifier.predict(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array([x[0] for x in out], pa.string()),
                    pa.array([x[1] for x in out], pa.float64()),
                    pa.array([x[2] for x in out], pa.bool_()),
                ],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "reliable"],
            )

    return kept.mapInArrow(run, schema)
