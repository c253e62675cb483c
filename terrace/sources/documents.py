"""JSON documents as records, whatever their size.

A multi-line JSON reader gives a whole document to one task and keeps all its rows in memory.
Here a document is read in pieces that end at a ``}``, by as many tasks as its length asks
for, and gathered in chunks.  Whether a chunk begins inside a string, and how deep in
brackets, follows from the chunks before it: each counts its quotes and brackets for either
case, and running sums per file settle which one holds.  Knowing that, every chunk cuts out
the records that lie within it; what is left at its ends is joined to its neighbours' ends.

The text of a record is kept as it is.  A document is an array of objects, or one object.  What is
no such thing comes out with a reason instead of being lost: a document of another kind, an
element that is no object, a record the file breaks off in, and what follows a document's end.

Chunks lie as Parquet in the shared folder while they are cut: the raw files are read once.
A record must fit a row of Spark (2 GB).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.layout import ship_library, workspace

#: Bytes after which a chunk is closed.
CHUNK = 1 << 20
CHUNKS = (
    "path string, size long, block long, n long, text binary, length long, first string, quotes long, "
    "delta0 long, low0 long, delta1 long, low1 long"
)
PARTS = "path string, block long, n long, part int, text string, closes boolean, whole boolean, outside boolean"
NO_BRACKET = 1 << 40

QUOTE, BACKSLASH, COMMA = (ord(c) for c in '"\\,')
_STEP = np.zeros(256, np.int64)
_STEP[[ord("["), ord("{")]], _STEP[[ord("]"), ord("}")]] = 1, -1
_MARK = (_STEP != 0) | (np.arange(256) == COMMA)
_BLANK = b" \t\r\n\xef\xbb\xbf"
#: The same for expressions: white space and byte order marks.
_SPACE = r"[ \t\r\n\x{feff}]"


def _quotes(text: np.ndarray) -> np.ndarray:
    """Places of the quotes that no backslash takes."""
    at = np.flatnonzero(text == QUOTE)
    after = at[(at > 0) & (text[at - 1] == BACKSLASH)]
    taken = []
    for place in after.tolist():
        start = place
        while start and text[start - 1] == BACKSLASH:
            start -= 1
        if (place - start) % 2:
            taken.append(place)
    return np.setdiff1d(at, taken, assume_unique=True) if taken else at


def marks(text: bytes, in_string: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the brackets and commas outside strings, and the step in depth each one makes."""
    points = np.frombuffer(text, np.uint8)
    at = np.flatnonzero(_MARK[points])
    inside = (np.searchsorted(_quotes(points), at) + in_string) % 2
    at = at[inside == 0]
    return at, _STEP[points[at]]


def _described(path: str, size: int, block: int, n: int, text: bytes) -> tuple:
    found = []
    for in_string in (0, 1):
        _, step = marks(text, in_string)
        depth = np.cumsum(step)[step != 0]
        found += [int(step.sum()), int(depth.min()) if len(depth) else NO_BRACKET]
    first = text.lstrip(_BLANK)[:1].decode("latin-1")
    quotes = len(_quotes(np.frombuffer(text, np.uint8)))
    return (path, size, block, n, text, len(text), first, quotes, *found)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


_CHUNK_SCHEMA = pa.schema(
    [("path", pa.string()), ("size", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("text", pa.binary())]
    + [("length", pa.int64()), ("first", pa.string())]
    + [(c, pa.int64()) for c in ("quotes", "delta0", "low0", "delta1", "low1")]
)
_PART_SCHEMA = pa.schema(
    [("path", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("part", pa.int32()), ("text", pa.string())]
    + [(c, pa.bool_()) for c in ("closes", "whole", "outside")]
)


def _gather(chunk: int):
    """Pieces of a block of a file, in order, as chunks; each piece gets its ``}`` back."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, n, held, pieces = None, 0, 0, []

        def close() -> pa.RecordBatch:
            return _batch([_described(*of, n, b"}".join([*pieces, b""]))], _CHUNK_SCHEMA)

        for batch in batches:
            for path, size, block, piece in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (path, size, block) != of:
                    if pieces:
                        yield close()
                    of, n, held, pieces = (path, size, block), 0, 0, []
                pieces.append(piece)
                held += len(piece) + 1
                if held >= chunk:
                    yield close()
                    n, held, pieces = n + 1, 0, []
        if pieces:
            yield close()

    return gather


def cut(text: bytes, in_string: int, depth: int, closed: bool, array: bool) -> Iterator[tuple[bytes, bool, bool]]:
    """The parts of a chunk as (text, whether a record ends with it, whether it is outside the document).

    All parts but the first and the last are whole elements.  In an array elements end at commas
    of depth 1 and at the bracket that closes it; a single object ends where its depth is 0 again.
    """
    if closed:
        yield text, False, True
        return
    at, step = marks(text, in_string)
    after = depth + np.cumsum(step)
    ends = (step == -1) & (after == 0)
    end = int(np.flatnonzero(ends)[0]) if ends.any() else len(at)
    at, step, after = at[: end + 1], step[: end + 1], after[: end + 1]
    if array:
        opening = (step == 1) & (after == 1)
        cuts = at[((step == 0) & (after == 1)) | opening | ((step == -1) & (after == 0))]
        start = 0
        for place in cuts.tolist():
            yield text[start:place], True, False
            start = place + 1
    else:
        start = 0
        if end < len(at):
            start = int(at[end]) + 1
            yield text[:start], True, False
    yield text[start:], False, end < len(at)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            if row["in_string"] is None or row["depth"] is None:
                raise ValueError(f"no state for block {row['block']} of {row['path']}")
            text = row["text"][: len(row["text"]) - row["spare"]]
            key = (row["path"], row["block"], row["n"])
            if row["first"] not in ("[", "{"):
                yield _batch([(*key, 0, text.decode("utf-8", "replace"), True, False, True)], _PART_SCHEMA)
                continue
            parts = list(cut(text, row["in_string"], row["depth"], row["closed"], row["first"] == "["))
            rows = [
                (*key, i, t.decode("utf-8", "replace"), closes, closes and i > 0 and not outside, outside)
                for i, (t, closes, outside) in enumerate(parts)
            ]
            yield _batch(rows, _PART_SCHEMA)


def read_documents(
    spark: SparkSession, paths: str | Sequence[str], *, options: Mapping[str, str] | None = None, chunk: int = CHUNK
) -> DataFrame:
    """``path, record, reason`` for every record of the documents under ``paths``.

    ``reason`` is null for objects that can be parsed with the JSON ``options`` and says what is
    wrong otherwise; ``record`` is then the text in question.
    """
    ship_library(spark)
    pieces = (
        spark.read.option("lineSep", "}")
        .option("recursiveFileLookup", "true")
        .text(paths)
        .select("_metadata.file_path", "_metadata.file_size", "_metadata.file_block_start", F.col("value").cast("binary"))
    )
    staged = workspace(spark)
    pieces.mapInArrow(_gather(chunk), CHUNKS).write.parquet(staged)
    chunks = spark.read.schema(CHUNKS).parquet(staged)

    file = Window.partitionBy("path")
    order = file.orderBy("block", "n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def earlier(value: Column) -> Column:
        return F.coalesce(value.over(before), F.lit(0))

    in_string = (earlier(F.sum("quotes")) % 2).cast("int")
    inside = F.col("in_string") == 1
    states = (
        chunks.drop("text")
        .withColumn("in_string", in_string)
        .withColumn("delta", F.when(inside, F.col("delta1")).otherwise(F.col("delta0")))
        .withColumn("low", F.when(inside, F.col("low1")).otherwise(F.col("low0")))
        .withColumn("depth", earlier(F.sum("delta")).cast("int"))
        .withColumn("closed", F.coalesce(F.min(F.col("depth") + F.col("low")).over(before) <= 0, F.lit(False)))
        # The piece a file ends with may have had no bracket to give back: then all pieces are a byte
        # longer than the file, less the three of a byte order mark, which is not read.
        .withColumn("last", F.lead(F.lit(1)).over(order).isNull())
        .withColumn("spare", (F.col("last") & (F.sum("length").over(file) - F.col("size")).isin(1, -2)).cast("int"))
        .withColumn("kind", F.first(F.when(F.col("first") != "", F.col("first")), ignorenulls=True).over(everything))
        .select(
            *[F.col(c).alias(f"s_{c}") for c in ("path", "block", "n")],
            "in_string", "depth", "closed", "spare", F.coalesce("kind", F.lit("")).alias("first"),
        )
    )
    same = [F.col(c) == F.col(f"s_{c}") for c in ("path", "block", "n")]
    parts = (
        chunks.drop("first")
        .join(states, same, "left")
        .select("path", "block", "n", "text", "in_string", "depth", "closed", "spare", "first")
        .mapInArrow(_split, PARTS)
    )
    blank = F.col("text").rlike(rf"^{_SPACE}*$")
    whole = parts.where(F.col("whole") & ~blank).select("path", F.col("text").alias("record"), F.lit(None).cast("string").alias("reason"))
    spans = Window.partitionBy("path").orderBy("block", "n", "part").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        parts.where(~F.col("whole"))
        .withColumn("group", F.coalesce(F.sum(F.col("closes").cast("int")).over(spans), F.lit(0)))
        .groupBy("path", "outside", "group")
        .agg(
            F.array_join(F.sort_array(F.collect_list(F.struct("block", "n", "part", "text")))["text"], "").alias("text"),
            F.max("closes").alias("closes"),
        )
        .where(~blank)
        .select(
            "path",
            F.col("text").alias("record"),
            F.when(F.col("outside"), "not part of a JSON array or object")
            .when(~F.col("closes"), "the document ends before the record does")
            .alias("reason"),
        )
    )
    found = whole.unionByName(ends).withColumn("record", F.regexp_replace("record", rf"^{_SPACE}+|{_SPACE}+$", ""))
    parser = {**(options or {}), "columnNameOfCorruptRecord": "_corrupt_record", "multiLine": "false"}
    parsed = F.from_json("record", "_none string, _corrupt_record string", parser)
    wrong = F.when(~F.col("record").startswith("{"), "not an object").when(parsed["_corrupt_record"].isNotNull(), "not valid JSON")
    return found.withColumn("reason", F.coalesce("reason", wrong))


def as_arrays(records: DataFrame) -> DataFrame:
    """Lines in ``value`` that make every task's records one JSON array; the first task has one even without any."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            texts = batch.column(0).to_pylist()
            if texts:
                lead = [("," if begun or i else "[\n") + t for i, t in enumerate(texts)]
                begun = True
                yield pa.RecordBatch.from_arrays([pa.array(lead, pa.string())], ["value"])
        if begun or TaskContext.get().partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array(["]" if begun else "[]"], pa.string())], ["value"])

    return records.select("record").mapInArrow(lines, "value string")
