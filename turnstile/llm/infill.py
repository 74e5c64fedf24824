"""Fill-in-the-middle documents by a piece table.

A document is a list of descriptors (buffer, start, stop) over two buffers that
never change: its own text and the sentinels. Cutting splits descriptors, an
arrangement permutes them and puts descriptors of sentinels between, the inverse
permutation gives back the text, and hashes stream what the descriptors name.
Text bytes are copied once, where an output is asked for as a column.
"""

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.shared import batch, parts

# The sentinel before each part, and each form's order of the parts,
# which are numbered prefix 0, middle 1, suffix 2.
SENTINELS = (b"<P>", b"<M>", b"<S>")
FORMS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
PLAIN = "plain"

_ARRANGED = "n long, form string, prefix_chars long, middle_chars long, pieces array<struct<buffer:string,start:long,length:long>>, output string, output_sha256 string"
_RESTORED = "restored string, restored_sha256 string"
_PIECE = pa.struct([("buffer", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
_OWN = {
    _ARRANGED: [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(_PIECE), pa.string(), pa.string()],
    _RESTORED: [pa.string(), pa.string()],
}

#: Buffers by number.
TEXT, SENTINEL = 0, 1
_NAMES = ("text", "sentinel")
_MARKS = memoryview(b"".join(SENTINELS))
_ENDS = np.cumsum([0, *map(len, SENTINELS)]).tolist()


@dataclass(frozen=True)
class PieceTable:
    """Descriptors over ``text`` and the sentinels, in reading order."""

    text: memoryview
    pieces: tuple[tuple[int, int, int], ...]

    @classmethod
    def of(cls, text: memoryview) -> "PieceTable":
        return cls(text, ((TEXT, 0, len(text)),))

    def cut(self, places: Sequence[int]) -> "PieceTable":
        """The same bytes, split at each of the ascending ``places``. A place where
        two pieces meet, or one given twice, yields an empty piece."""
        pieces, left, done = [], list(places), 0
        for buffer, start, stop in self.pieces:
            while left and left[0] <= done + stop - start:
                at = start + left.pop(0) - done
                pieces.append((buffer, start, at))
                done, start = done + at - start, at
            pieces.append((buffer, start, stop))
            done += stop - start
        return PieceTable(self.text, tuple(pieces))

    def arranged(self, order: Sequence[int]) -> "PieceTable":
        """The pieces in another order, each behind its sentinel."""
        marked = [p for i in order for p in ((SENTINEL, _ENDS[i], _ENDS[i + 1]), self.pieces[i])]
        return PieceTable(self.text, tuple(marked))

    def restored(self, order: Sequence[int]) -> "PieceTable":
        """The inverse of ``arranged``: every second piece, put back in its place."""
        back = sorted(zip(order, self.pieces[1::2], strict=True))
        return PieceTable(self.text, tuple(p for _, p in back))

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, stop in self.pieces:
            yield (_MARKS if buffer else self.text)[start:stop]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def materialised(self) -> bytes:
        return b"".join(self.stream())

    def described(self) -> list[dict]:
        return [{"buffer": _NAMES[b], "start": i, "length": j - i} for b, i, j in self.pieces]


def parsed(output: memoryview, form: str) -> PieceTable:
    """The piece table of a rendered output, cut where its sentinels stand.

    Raises on an output that is not of the form.
    """
    whole = PieceTable.of(output)
    if form == PLAIN:
        return whole
    held, places = bytes(output), []
    for i in FORMS[form]:
        at = held.index(SENTINELS[i], places[-1] if places else 0)
        places += [at, at + len(SENTINELS[i])]
    if places[0]:
        raise ValueError("an output starts with a sentinel")
    return PieceTable(output, whole.cut(places).pieces[1:])


def _buffers(column: pa.Array) -> Iterator[memoryview | None]:
    """Each text as a view of the batch's own bytes, None for null."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    data = memoryview(data) if data else memoryview(b"")
    for i, known in enumerate(column.is_valid().to_pylist()):
        yield data[ends[i] : ends[i + 1]] if known else None


def _chars(part: memoryview) -> int:
    """Code points: bytes that do not continue one."""
    return int(np.count_nonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80)) if len(part) else 0


def _units(text: memoryview) -> np.ndarray:
    """Where the lines end; the last one may have no line feed."""
    if not len(text):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if len(ends) and ends[-1] == len(text) else np.append(ends, len(text))


def _draws(key: str | None, seed: int) -> tuple[int, ...]:
    """Four 32-bit numbers of the key."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4))


def infilled(text: memoryview, key: str | None, seed: int, rate: int, spm: int) -> tuple[int, str, PieceTable]:
    """The number of lines, the form, and the document's pieces in that form."""
    one, two, three, four = _draws(key, seed)
    ends = _units(text)
    n, held = len(ends), bytes(text)
    if not n or three % 100 >= rate or any(s in held for s in SENTINELS):
        return n, PLAIN, PieceTable.of(text)
    places = [int(ends[k - 1]) if k else 0 for k in sorted((one % (n + 1), two % (n + 1)))]
    form = "spm" if four % 100 < spm else "psm"
    return n, form, PieceTable.of(text).cut(places).arranged(FORMS[form])


def _arrange(names: list[str], schema: pa.Schema, seed: int, rate: int, spm: int, output: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            rows = []
            for text, key in zip(_buffers(b.column("__text")), b.column("__key").to_pylist(), strict=True):
                text = memoryview(b"") if text is None else text
                n, form, table = infilled(text, key, seed, rate, spm)
                chars = (None, None)
                if form != PLAIN:
                    # Prefix and middle by number, wherever the form has put them.
                    both = table.restored(FORMS[form]).stream()
                    chars = (_chars(next(both)), _chars(next(both)))
                rows.append((n, form, *chars, table.described(), table.materialised() if output else None, table.sha256()))
            yield batch(schema, *(b.column(c) for c in names), *_columns(rows, schema))

    return run


def _restore(names: list[str], schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            rows = []
            for output, form in zip(_buffers(b.column("__output")), b.column("__form").to_pylist(), strict=True):
                if output is None or form is None:
                    rows.append((None, None))
                    continue
                table = parsed(output, form)
                table = table if form == PLAIN else table.restored(FORMS[form])
                rows.append((table.materialised(), table.sha256()))
            yield batch(schema, *(b.column(c) for c in names), *_columns(rows, schema))

    return run


def _columns(rows: list[tuple], schema: pa.Schema) -> list[pa.Array]:
    """Text from bytes, all else as it comes."""
    n = len(rows[0]) if rows else 0
    fields = list(schema)[-n:] if n else []
    made = []
    for f, values in zip(fields, zip(*rows, strict=True), strict=True):
        raw = any(isinstance(v, bytes) for v in values)
        made.append(pa.array(values, pa.binary()).cast(f.type) if raw else pa.array(values, f.type))
    return made


def _run(rows: DataFrame, keep: Sequence[str], inputs: dict, own: str, task) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    added = T.StructType.fromDDL(own)
    kept = [c for c in keep if c.lower() not in {n.lower() for n in added.names}]
    # Numbered names: no name of the input can clash with one that is needed here.
    names = [f"c{i}" for i in range(len(kept))]
    source = rows.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)), *(c.alias(n) for n, c in inputs.items()))
    schema = T.StructType([*source.schema.fields[: len(names)], *added.fields])
    arrow = to_arrow_schema(schema)
    arrow = pa.schema([*list(arrow)[: len(names)], *(pa.field(n, t) for n, t in zip(added.names, _OWN[own], strict=True))])
    done = source.mapInArrow(task(names, arrow), schema)
    return done.toDF(*kept, *added.names)


def fill_in_middle(
    docs: DataFrame,
    keep: Sequence[str],
    text: str = "text",
    doc_id: str = "doc_id",
    seed: int = 7,
    rate: int = 100,
    spm: int = 50,
    output: bool = True,
) -> DataFrame:
    """The columns ``keep`` of each row with its fill-in-the-middle form.

    n              lines of the text, the last one with or without a line feed
    form           ``plain``, ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle)
    prefix_chars, middle_chars   code points of these parts, null if plain
    pieces         the output's descriptors: buffer (``text`` or ``sentinel``),
                   start and length in bytes; sentinels stand in the order of SENTINELS
    output         what the descriptors name, as text (null with ``output=False``)
    output_sha256  its hash, streamed from the descriptors

    The cuts fall between lines; they, and the form, follow from a hash of ``seed``
    and the id alone, so any row can be redone on its own. ``rate``: per cent of
    documents that are cut; ``spm``: per cent of those in the form spm. Whole texts
    of any length; the work on one is linear in its bytes. Null texts count as
    empty; empty ones, and such as hold a sentinel, stay plain. A null id is hashed
    as no text. Repeated rows all return, alike. A column of ``keep`` with the name
    of an added one gives way to it.
    """
    inputs = {"__text": F.col(f"`{text}`").cast("string"), "__key": F.col(f"`{doc_id}`").cast("string")}
    return _run(docs, keep, inputs, _ARRANGED, lambda names, schema: _arrange(names, schema, seed, rate, spm, output))


def restore(rows: DataFrame, keep: Sequence[str], output: str = "output", form: str = "form") -> DataFrame:
    """The columns ``keep`` with ``restored``, the text as it was before
    ``fill_in_middle``, and ``restored_sha256``.

    Works from the output and its form alone: the output is parsed at its
    sentinels, and the form's inverse permutation puts the pieces back. A null
    output or form gives nulls; an output that is not of its form is an error.
    """
    inputs = {"__output": F.col(f"`{output}`").cast("string"), "__form": F.col(f"`{form}`").cast("string")}
    return _run(rows, keep, inputs, _RESTORED, _restore)
