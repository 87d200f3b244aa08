"""One large dataset file read by many tasks.

Spark's text source cuts a file into byte ranges by itself if it is told that lines end
in a closing brace; whatever store the file is in, only Spark opens it. Such lines are put
together to chunks of bounded size. Where a chunk begins, in a string or not, under
which open brackets, depends on all before it, so every chunk is read from both states
of its range's start, and the ranges' transitions are composed, one row per range. With
the state known, every chunk gives the elements of the reviews array that lie in it;
one that a border cuts is put together again from its parts.

What is outside of the array, the skeleton, is a few bytes and is parsed as one document.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from revlens import fixed_values as fixed
from revlens.sources.tables import keep

CHUNK_BYTES = 4 << 20
NOT_JSON = "is not valid JSON"

#: A whole string, or a structural character; a quote alone opens a string that does not end here.
_TOKEN = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"|["{}\[\],]', re.S)
#: The rest of a string that began earlier.
_REST = re.compile(rb'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)
_QUOTE, _COMMA = b'",'
_WHITE = b" \t\r\n"

#: Open brackets are written as a string: an object, an array, the array of reviews.
_OBJECT, _ARRAY, _REVIEWS = "{", "[", "r"

_AT = "inside boolean, pops int, opened string"
_CHUNK = (
    "file string, block long, size long, chunk int, text binary, last boolean, bytes long, "
    f"plain struct<{_AT}>, quoted struct<{_AT}>, plain_end struct<{_AT}>, quoted_end struct<{_AT}>"
)
_BLOCK = "file string, block long, inside boolean, stack string, unended boolean, final boolean"
_PARTS = (
    "file string, block long, chunk int, skeleton string, problem string, arrays int, "
    "array_of array<int>, opens array<boolean>, closes array<boolean>, texts array<string>"
)


class _Walk:
    """Where a reader is, relative to where it began: in a string or not, how many brackets of
    before are closed, and which are open."""

    def __init__(self, inside: bool):
        self.inside, self.pops, self.opened = inside, 0, []

    def over(self, text: bytes) -> None:
        key = None
        for at, end, sign in _tokens(text, self):
            if sign == _QUOTE:
                key = (at, end)
            elif sign in b"{[":
                self.opened.append(_kind(text, at, sign, key))
            elif sign in b"}]":
                if self.opened:
                    self.opened.pop()
                else:
                    self.pops += 1

    def row(self) -> dict:
        return {"inside": self.inside, "pops": self.pops, "opened": "".join(self.opened)}


def _tokens(text: bytes, walk: _Walk) -> Iterator[tuple[int, int, int]]:
    """Start, end and first byte of the strings and structural signs; keeps ``walk.inside``."""
    start = 0
    if walk.inside:
        rest = _REST.match(text)
        if rest is None:
            return
        start, walk.inside = rest.end(), False
    for found in _TOKEN.finditer(text, start):
        at, end = found.span()
        sign = text[at]
        if sign == _QUOTE and end - at == 1:
            walk.inside = True
            return
        yield at, end, sign


def _kind(text: bytes, at: int, sign: int, key: tuple[int, int] | None) -> str:
    if sign == b"{"[0]:
        return _OBJECT
    if key is None or text[key[1] : at].strip(_WHITE) != b":":
        return _ARRAY
    try:
        return _REVIEWS if json.loads(text[key[0] : key[1]]) == fixed.REVIEWS_KEY else _ARRAY
    except ValueError:
        return _ARRAY


def _moved(inside: bool, stack: str, at) -> tuple[bool, str]:
    """The state after a transition that begins at ``(inside, stack)``."""
    return at["inside"], stack[: max(0, len(stack) - at["pops"])] + at["opened"]


def chunks(pieces: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of about ``chunk_bytes`` from lines ``(file, block, size, piece)`` that ended in
    a brace, with their states relative to their byte range's start."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts = None, []
        held, chunk, in_block = 0, 0, 0
        plain, quoted = _Walk(False), _Walk(True)

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal parts, held, chunk
            text = b"}".join(parts) + b"}"
            row = dict(zip(("file", "block", "size"), place), chunk=chunk, text=text, last=last, bytes=in_block)
            row |= {"plain": plain.row(), "quoted": quoted.row()}
            plain.over(text)
            quoted.over(text)
            row |= {"plain_end": plain.row(), "quoted_end": quoted.row()}
            parts, held, chunk = [], 0, chunk + 1
            return pa.RecordBatch.from_pylist([row], schema=_arrow)

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("file", "block", "size", "piece"))
            for file, block, size, piece in zip(*columns):
                if (file, block, size) != place:
                    if place is not None:
                        yield flush(True)
                    place, chunk, in_block = (file, block, size), 0, 0
                    plain, quoted = _Walk(False), _Walk(True)
                elif held >= chunk_bytes:
                    yield flush(False)
                parts.append(piece)
                held += len(piece) + 1
                in_block += len(piece) + 1
        if place is not None:
            yield flush(True)

    state = pa.struct([("inside", pa.bool_()), ("pops", pa.int32()), ("opened", pa.string())])
    _arrow = pa.schema(
        [
            ("file", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("chunk", pa.int32()),
            ("text", pa.binary()), ("last", pa.bool_()), ("bytes", pa.int64()),
            ("plain", state), ("quoted", state), ("plain_end", state), ("quoted_end", state),
        ]
    )
    return pieces.mapInArrow(cut, _CHUNK)


def _blocks(cut: DataFrame) -> DataFrame:
    """The state at the start of every byte range: one small row per range is composed."""

    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        inside, stack, rows = False, "", []
        # Every line counted one brace; if the file does not end in one, there is one too many.
        unended = int(frame["bytes"].sum()) > int(frame["size"].iloc[0])
        final = frame["block"].iloc[-1]
        for file, block, plain, quoted in zip(frame["file"], frame["block"], frame["plain_end"], frame["quoted_end"]):
            rows.append((file, block, inside, stack, unended, block == final))
            inside, stack = _moved(inside, stack, quoted if inside else plain)
        return pd.DataFrame(rows, columns=["file", "block", "inside", "stack", "unended", "final"])

    ends = cut.where("last").select("file", "block", "size", "bytes", "plain_end", "quoted_end")
    return ends.groupBy("file").applyInPandas(compose, _BLOCK)


def _parts(text: bytes, inside: bool, stack: list[str], final: bool) -> tuple:
    """What a chunk holds, from the state it begins in: skeleton, problem, arrays of reviews that
    begin in it, and the parts of their elements."""

    def depth() -> int:
        """How deep the elements are if the reader is in the array, else 0."""
        if stack[:1] in ([_ARRAY], [_REVIEWS]):
            return 1
        return 2 if stack[:2] == [_OBJECT, _REVIEWS] else 0

    walk, key, level = _Walk(inside), None, depth()
    start, opens, arrays = 0, False, 0
    skeleton, found, problem = [], [], None
    for at, end, sign in _tokens(text, walk):
        if sign == _QUOTE:
            key = (at, end)
        elif sign == _COMMA:
            if level and len(stack) == level:
                found.append((arrays, opens, True, text[start:at]))
                start, opens = end, True
        elif sign in b"{[":
            stack.append(_kind(text, at, sign, key))
            if not level and (level := depth()):
                skeleton.append(text[start:end])
                start, opens, arrays = end, True, arrays + 1
        else:
            if not stack or (stack[-1] == _OBJECT) != (sign == b"}"[0]):
                problem = NOT_JSON
                break
            if level and len(stack) == level:
                found.append((arrays, opens, True, text[start:at]))
                start, level = at, 0
            stack.pop()
    if level:
        found.append((arrays, opens, False, text[start:]))
    else:
        skeleton.append(text[start:])
    if final and (stack or walk.inside):
        problem = NOT_JSON
    return b"".join(skeleton), problem, arrays, found


def _elements(cut: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row per chunk: its part of the skeleton, and its elements and parts of them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                text = row["text"]
                final = row["final"] and row["last"]
                if final and row["unended"]:
                    text = text[:-1]
                inside, stack = _moved(row["inside"], row["stack"], row["quoted" if row["inside"] else "plain"])
                skeleton, problem, arrays, found = _parts(text, inside, list(stack), final)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]]), pa.array([row["block"]], pa.int64()),
                        pa.array([row["chunk"]], pa.int32()),
                        pa.array([skeleton], pa.binary()), pa.array([problem], pa.string()),
                        pa.array([arrays], pa.int32()),
                        pa.array([[x[0] for x in found]], pa.list_(pa.int32())),
                        pa.array([[x[1] for x in found]], pa.list_(pa.bool_())),
                        pa.array([[x[2] for x in found]], pa.list_(pa.bool_())),
                        pa.array([[x[3] for x in found]], pa.list_(pa.binary())),
                    ],
                    names=[c.split()[0] for c in _BINARY.split(", ")],
                )

    _BINARY = _PARTS.replace("skeleton string", "skeleton binary").replace("texts array<string>", "texts array<binary>")
    carried = ["file", "block", "chunk", "text", "last", "plain", "quoted"]
    # One row per range on the right; the ranges of a file of any size are many small keys.
    joined = cut.select(*carried).join(blocks, ["file", "block"])
    return joined.mapInArrow(read, _BINARY)


def split_records(pieces: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(file, pos, text)`` of the elements of the files' arrays, and per file its
    ``skeleton`` and a ``problem`` (null if there is none) of its structure.

    The last array of reviews counts if a file has several, as for any repeated key.
    """
    cut = keep(chunks(pieces, chunk_bytes))
    parts = keep(_elements(cut, _blocks(cut)))
    in_file = Window.partitionBy("file").orderBy("block", "chunk")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    # How many entries of a chunk belong to earlier arrays, and how many elements of the last
    # array begin in it: narrow columns, one row per chunk.
    earlier = F.size(F.filter("array_of", lambda a: a + F.col("_arrays") < F.col("_all")))
    begins = F.expr("CASE WHEN skipped < size(opens) THEN size(opens) - skipped - IF(opens[skipped], 0, 1) ELSE 0 END")
    places = (
        parts.select("file", "block", "chunk", "arrays", "array_of", "opens")
        .withColumn("_arrays", F.coalesce(F.sum("arrays").over(before), F.lit(0)))
        .withColumn("_all", F.sum("arrays").over(whole))
        .withColumn("skipped", earlier)
        .withColumn("_begins", begins)
        .select(
            "file", "block", "chunk", "skipped",
            F.coalesce(F.sum("_begins").over(before), F.lit(0)).alias("offset"),
            F.sum("_begins").over(whole).alias("elements"),
        )
    )
    entry = F.posexplode(F.arrays_zip("opens", "closes", "texts")).alias("at", "e")
    listed = (
        parts.select("file", "block", "chunk", "opens", "closes", "texts")
        .join(places, ["file", "block", "chunk"])
        .select(
            "file", "block", "chunk", "elements", "skipped", entry,
            (F.col("offset") - F.col("skipped") - F.when(F.get("opens", "skipped"), 0).otherwise(1)).alias("_from"),
        )
        .where("at >= skipped")
        .select(
            "file", "block", "chunk", "elements", "e.opens", "e.closes", F.col("e.texts").cast("string").alias("text"),
            "at", (F.col("_from") + F.col("at")).alias("pos"),
        )
    )
    columns = ["file", "pos", "elements", "text"]
    complete = listed.where("opens AND closes").select(*columns)
    # At most two parts per chunk: an element's parts follow the one that begins it.
    started = F.sum(F.col("opens").cast("int")).over(
        Window.partitionBy("file").orderBy("block", "chunk", "at")
    )
    in_order = F.array_sort(F.collect_list(F.struct("block", "chunk", "at", "text")))
    joined = (
        listed.where("NOT (opens AND closes)")
        .withColumn("_element", started)
        .groupBy("file", "elements", "_element")
        .agg(
            F.min(F.when(F.col("opens"), F.col("pos"))).alias("pos"),
            F.array_join(F.transform(in_order, lambda x: x["text"]), "").alias("text"),
        )
        .select(*columns)
    )
    # An empty array is one blank element.
    blank = (F.col("elements") == 1) & (F.trim(F.translate("text", "\t\r\n", "")) == "")
    elements = complete.unionByName(joined).where(~blank).select("file", "pos", "text")

    skeletons = F.array_sort(F.collect_list(F.struct("block", "chunk", F.col("skeleton").cast("string").alias("text"))))
    files = parts.groupBy("file").agg(
        F.array_join(F.transform(skeletons, lambda x: x["text"]), "").alias("skeleton"),
        F.min("problem").alias("problem"),
    )
    return elements, files
