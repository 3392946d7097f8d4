"""Fill-in-the-middle texts by secondary sort: pieces of a document are sorted into the order of its output and streamed into digests.

A document is cut into prefix, middle and suffix at two places that its id decides, and put out as ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
(psm), ``<S>`` suffix ``<P>`` prefix ``<M>`` middle (spm) or as it is (plain). Each part goes out in pieces of at most ``unit`` code points, keyed by the
row and their position in the output. Partitioning by row and sorting by (row, position) brings the pieces into order, so the output is digested as a
stream, one piece at a time. The same pass finds the three marks in the stream, wherever they were cut, and hands on what lies between them with its
position in the text; sorting anew, without another shuffle, gives the text back for the second digest. A document of any length never has
to be in memory as a whole after it has been cut.

``transform`` returns the output texts, ``restore`` the texts of outputs, ``digests`` lengths and checksums by the streams.

Cases: a null text counts as empty; an empty text and one that holds a mark stay plain; a null id counts as empty text in the hash; repeated rows are put
out each, as rows are told apart by their place in the input; rows with one id are cut by the same numbers; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
_RANK = {"prefix": 0, "middle": 1, "suffix": 2}  # order of the parts in the text
_END = 3  # after all parts: what is known of the whole document
_SHIFT = 1 << 48  # positions in a part are below this


def cut(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = 1, plain: int = 10, spm: int = 20) -> DataFrame:
    """row, doc_id, text, n, form and the two ends low and high; ``plain`` and ``spm`` are percentages."""
    frame = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    frame = frame.withColumns({"hexed": hexed, "n": F.char_length("text").cast("long")})

    def number(i: int) -> Column:
        return F.conv(F.substring("hexed", 8 * i - 7, 8), 16, 10).cast("long")

    frame = frame.withColumns({"a": number(1) % (F.col("n") + 1), "b": number(2) % (F.col("n") + 1)})
    marked = F.lit(False)
    for mark in MARKS.values():
        marked = marked | F.col("text").contains(mark)
    form = (F.when((F.col("n") == 0) | marked | (number(3) % 100 >= 100 - plain), "plain")
            .when(number(4) % 100 < spm, "spm").otherwise("psm"))
    return frame.select("row", "doc_id", "text", "n", form.alias("form"), F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))


_PIECE = [("row", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64()), ("form", pa.string()), ("text", pa.string())]
_PIECE_SCHEMA = "row long, at long, doc_id long, form string, text string"


def pieces(docs: DataFrame, unit: int = 4096, **options) -> DataFrame:
    """row, at (position in the output), doc_id, form, text: each part's mark with its first piece, in the order of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out: list[list] = [[] for _ in _PIECE]
                some = batch.slice(start, 256)
                for row, doc, text, form, low, high in zip(*[some.column(c).to_pylist() for c in ("row", "doc_id", "text", "form", "low", "high")]):
                    if form == "plain":
                        parts, order = {"": text}, ("",)
                    else:
                        parts, order = {"prefix": text[:low], "middle": text[low:high], "suffix": text[high:]}, FORMS[form]
                    at, begins = 0, {}
                    for part in order:
                        begins[part] = at
                        at += len(parts[part]) + len(MARKS.get(part, ""))
                    for part, own in parts.items():
                        mark = MARKS.get(part, "")
                        for k in range(0, max(1, len(own)), unit):
                            where = begins[part] + (k + len(mark) if k else 0)
                            for column, value in zip(out, (row, where, doc, form, (own[k: k + unit] if k else mark + own[:unit]))):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, _PIECE)], names=[n for n, _ in _PIECE])

    return cut(docs, **options).select("row", "doc_id", "text", "form", "low", "high").mapInArrow(run, _PIECE_SCHEMA)


def in_order(found: DataFrame) -> DataFrame:
    """Pieces of a row together, in the order of the output: a row is a key of its own, so no key is hot."""
    return found.repartition("row").sortWithinPartitions("row", "at")


class Parts:
    """Finds the marks of a form in a stream of pieces and names the part of what lies between them."""

    def __init__(self, form: str) -> None:
        self.open = [*FORMS.get(form, ())]
        self.part, self.held = ("" if self.open else "prefix"), ""

    def feed(self, text: str) -> list[tuple[str, str]]:
        out, text = [], self.held + text
        while self.open:
            mark = MARKS[self.open[0]]
            at = text.find(mark)
            if at < 0:
                keep = next((k for k in range(len(mark) - 1, 0, -1) if text.endswith(mark[:k])), 0)
                self.held = text[len(text) - keep:]
                text = text[: len(text) - keep]
                break
            out.append((self.part, text[:at]))
            self.part, text = self.open.pop(0), text[at + len(mark):]
        else:
            self.held = ""
        out.append((self.part, text))
        return [(part, own) for part, own in out if own]

    def rest(self) -> list[tuple[str, str]]:
        return [(self.part, self.held)] if self.held else []


_BACK = [("row", pa.int64()), ("to", pa.int64()), ("doc_id", pa.int64()), ("form", pa.string()), ("sha256", pa.string()), ("text", pa.string())]
_BACK_SCHEMA = "row long, to long, doc_id long, form string, sha256 string, text string"
_OUT = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
        ("output_sha256", pa.string()), ("restored_sha256", pa.string())]
_OUT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def _batch(rows: list[tuple], kinds: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Output digests, and what lies between the marks with its place in the text."""
    now, doc, form, digest, parts, sizes, rows = None, None, None, None, None, {}, []

    def place(found: list[tuple[str, str]]) -> None:
        for part, own in found:
            rows.append((now, _RANK[part] * _SHIFT + sizes.get(part, 0), None, None, None, own))
            sizes[part] = sizes.get(part, 0) + len(own)

    def close() -> None:
        if now is not None:
            place(parts.rest())
            rows.append((now, _END * _SHIFT, doc, form, digest.hexdigest(), None))

    for batch in batches:
        for row, name, kind, text in zip(*[batch.column(c).to_pylist() for c in ("row", "doc_id", "form", "text")]):
            if row != now:
                close()
                now, doc, form, digest, parts, sizes = row, name, kind, hashlib.sha256(), Parts(kind), {}
            digest.update(text.encode())
            place(parts.feed(text))
            if len(rows) >= 1000:
                yield _batch(rows, _BACK)
                rows.clear()
    close()
    if rows:
        yield _batch(rows, _BACK)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text digests; a document's last record ends it."""
    digest, sizes, rows = hashlib.sha256(), [0, 0, 0], []
    for batch in batches:
        for to, doc, form, output, text in zip(*[batch.column(c).to_pylist() for c in ("to", "doc_id", "form", "sha256", "text")]):
            rank = to // _SHIFT
            if rank < _END:
                digest.update(text.encode())
                sizes[rank] += len(text)
                continue
            known = form != "plain"
            rows.append((doc, sum(sizes), form, sizes[0] if known else None, sizes[1] if known else None, output, digest.hexdigest()))
            digest, sizes = hashlib.sha256(), [0, 0, 0]
        if rows:
            yield _batch(rows, _OUT)
            rows = []


def digests(docs: DataFrame, unit: int = 4096, **options) -> DataFrame:
    """One row for each document: its length, form and ends, and the digests of its output and of the text rebuilt from that."""
    back = in_order(pieces(docs, unit, **options)).mapInArrow(_digested, _BACK_SCHEMA)
    return back.sortWithinPartitions("row", "to").mapInArrow(_restored, _OUT_SCHEMA)


def transform(docs: DataFrame, unit: int = 4096, **options) -> DataFrame:
    """doc_id, form, output: the text to train on."""
    kinds = [("doc_id", pa.int64()), ("form", pa.string()), ("output", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, rows = None, None, []
        for batch in batches:
            for row, doc, form, text in zip(*[batch.column(c).to_pylist() for c in ("row", "doc_id", "form", "text")]):
                if row != now:
                    if held:
                        rows.append((*held[:2], "".join(held[2])))
                    now, held = row, (doc, form, [])
                held[2].append(text)
            if rows:
                yield _batch(rows, kinds)
                rows = []
        if held:
            yield _batch([(*held[:2], "".join(held[2]))], kinds)

    return in_order(pieces(docs, unit, **options)).mapInArrow(run, "doc_id long, form string, output string")


def restore(outputs: DataFrame, output: str = "output", form: str = "form", into: str = "text") -> DataFrame:
    """Adds the text of each output, from the output and its form alone."""
    first = F.when(F.col(form) == "spm", MARKS["suffix"]).otherwise(MARKS["prefix"])
    second = F.when(F.col(form) == "spm", MARKS["prefix"]).otherwise(MARKS["suffix"])
    whole = F.col(output)
    one, two = F.call_function("locate", second, whole), F.call_function("locate", F.lit(MARKS["middle"]), whole)
    front, back = F.substring(whole, F.length(first) + 1, one - F.length(first) - 1), F.substring(whole, one + 3, two - one - 3)
    middle = F.substring(whole, two + 3, F.length(whole))
    text = F.when(F.col(form) == "plain", whole).when(F.col(form) == "spm", F.concat(back, middle, front)).otherwise(F.concat(front, middle, back))
    return outputs.withColumn(into, text)


def sql(seed: int = 1, plain: int = 10, spm: int = 20) -> str:
    marked = " OR ".join(f"contains(t, '{m}')" for m in MARKS.values())
    return f"""
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
            AS output_sha256, sha256(p || m || s) AS restored_sha256
    FROM (SELECT *, substr(t, 1, low) AS p, substr(t, low + 1, high - low) AS m, substr(t, high + 1) AS s,
            CASE WHEN n = 0 OR {marked} OR h[3] % 100 >= {100 - plain} THEN 'plain' WHEN h[4] % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form
        FROM (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high
            FROM (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
                    list_transform(range(4), lambda i: ('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 8 * i + 1, 8))::BIGINT) AS h
                FROM documents)))"""
