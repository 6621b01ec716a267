"""One large JSON document, read by many tasks.

A landed document ``{coin: {"prices": [[ms, price], …]}}`` or ``{coin: text}`` can be one file of any size.
It is cut into byte ranges. A range can begin anywhere, inside a text too, so that a first pass describes
each range twice: as if it began inside a text and outside one. It notes how the range ends, how far
the nesting changes, and the last key on each level. Put in order, these few values per range say
exactly where every range stands: in a text or not, how deep, under which coin and field. A second pass
then gives the points, or texts, that begin in each range, reading on beyond its end for the last one.

This module is handed to the Python workers by value, and so imports nothing of its package.
"""

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

RANGE_BYTES = 32 << 20
POINTS_AT_ONCE = 1 << 16
TAIL = 1 << 16

COIN_LEVEL, FIELD_LEVEL, POINT_LEVEL = 1, 2, 4
MARKS = "path string, start long, stop long, marks string"
HISTORY = "coin_id string, timestamp_ms long, price_usd double"
DESCRIPTIONS = "coin_id string, description string"

_CHARS = np.zeros(256, dtype=bool)
_CHARS[list(b'"{}[]:,')] = True
_STEP = np.zeros(256, dtype=np.int64)
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1
_ESCAPE = re.compile(rb"\\.", re.DOTALL)


class MalformedDocument(ValueError):
    """A document that is not JSON of the expected form."""


def open_store(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system and path of a folder that all executors share."""
    path = re.sub(r"^s3[an]:", "s3:", path)
    if "://" not in path and not path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), path
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def list_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files in a folder, hidden ones apart."""
    store, place = open_store(path)
    info = store.get_file_info(place)
    if info.type == arrow_fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == arrow_fs.FileType.File:
        return [(path, info.size)]
    found = store.get_file_info(arrow_fs.FileSelector(place))
    files = [f for f in found if f.type == arrow_fs.FileType.File and f.base_name[0] not in "._"]
    return sorted((f"{path.rstrip('/')}/{f.base_name}", f.size) for f in files)


@dataclass
class Structure:
    """The structural characters of some bytes: positions, kinds, and the level behind each."""

    at: np.ndarray
    kind: np.ndarray
    level: np.ndarray
    inside: bool  # whether the bytes end inside a text

    def keys(self, data: bytes) -> Iterator[tuple[int, int, int]]:
        """(start, end, level) of the quoted keys; a text is a key if a colon follows it."""
        opening = np.flatnonzero(self.kind[:-2] == ord('"'))
        # Texts are pairs of quotes; of a pair the first one has even rank.
        first = opening[self._rank()[opening] % 2 == 0]
        first = first[(self.kind[first + 1] == ord('"')) & (self.kind[first + 2] == ord(":"))]
        yield from zip(
            self.at[first].tolist(), (self.at[first + 1] + 1).tolist(), self.level[first].tolist(), strict=True
        )

    def _rank(self) -> np.ndarray:
        quote = self.kind == ord('"')
        return np.cumsum(quote) - quote


def structure(data: bytes, in_text: bool, level: int, escaped: bool = False) -> Structure:
    """Structure of bytes that begin in or outside a text and on a level. A text that the bytes begin
    inside of is left out."""
    codes = np.frombuffer(data, dtype=np.uint8)
    at = np.flatnonzero(_CHARS[codes])
    if escaped and len(at) and at[0] == 0:
        at = at[1:]
    if b"\\" in data:
        start = 1 if escaped else 0
        hidden = np.fromiter((m.end() - 1 for m in _ESCAPE.finditer(data, start)), dtype=np.int64)
        at = at[~np.isin(at, hidden)]
    kind = codes[at]
    quote = kind == ord('"')
    count = np.cumsum(quote) + in_text
    within = (count - quote) % 2 == 1
    shown = quote | ~within
    if in_text and quote.any():
        shown[np.argmax(quote)] = False  # the end of the text that began before
    at, kind = at[shown], kind[shown]
    return Structure(at, kind, level + np.cumsum(_STEP[kind]), bool((quote.sum() + in_text) % 2))


class Range:
    """Bytes [start, stop) of a file, and as many behind them as are asked for."""

    def __init__(self, path: str, start: int, stop: int, size: int) -> None:
        self.store, self.place = open_store(path)
        self.start, self.stop, self.size = start, stop, size
        self.data = self._read(start, stop)
        self.escaped = start > 0 and self._slashes() % 2 == 1

    def _read(self, start: int, stop: int) -> bytes:
        with self.store.open_input_file(self.place) as source:
            return source.read_at(stop - start, start)

    def _slashes(self) -> int:
        """Backslashes right before the range: an odd number escapes its first byte."""
        count, end = 0, self.start
        while end > 0:
            part = self._read(max(0, end - 256), end)
            run = len(part) - len(part.rstrip(b"\\"))
            count, end = count + run, end - len(part)
            if run < len(part):
                break
        return count

    @property
    def whole(self) -> bool:
        return self.start + len(self.data) >= self.size

    def more(self) -> None:
        """Read on, by as much again as was read beyond the range, and TAIL at least."""
        end = self.start + len(self.data)
        beyond = max(TAIL, end - self.stop)
        self.data += self._read(end, min(self.size, end + beyond))


def _last_quote_open(found: Structure, length: int) -> bool:
    """Whether a text that begins in the first ``length`` bytes may be a key not read to its colon."""
    quotes = np.flatnonzero(found.kind == ord('"'))
    if not len(quotes):
        return False
    own = quotes[found.at[quotes] < length]
    if not len(own):
        return False
    last = own[len(own) - 1 - (len(own) - 1) % 2]  # the opening quote of the last text
    return last + 2 >= len(found.kind)


def describe(part: Range) -> dict[str, dict]:
    """For a beginning outside a text ("0") and inside one ("1"): whether the range ends inside, the change of
    level, and the last key on each level, counted from the level at the beginning."""
    out, length = {}, part.stop - part.start
    for in_text in (False, True):
        found = structure(part.data, in_text, 0, part.escaped)
        while _last_quote_open(found, length) and not part.whole:
            part.more()
            found = structure(part.data, in_text, 0, part.escaped)
        own = structure(part.data[:length], in_text, 0, part.escaped)
        last: dict[int, tuple[int, int]] = {}
        for start, end, level in found.keys(part.data):
            if start < length:
                last[level] = (start, end)
        out[str(int(in_text))] = {
            "inside": own.inside,
            "change": int(own.level[-1]) if len(own.level) else 0,
            "keys": [[level, start, _key(part.data[start:end])] for level, (start, end) in last.items()],
        }
    return out


def _key(quoted: bytes) -> str:
    try:
        return json.loads(quoted)
    except ValueError:
        return ""  # of the reading that does not hold


def place_ranges(marks: Sequence[dict]) -> list[dict]:
    """Where each range of one file stands, from the descriptions of all, in order."""
    out = []
    state = {"in_text": False, "level": 0, "coin": None, "field": None}
    for mark in marks:
        out.append({**mark["range"], **state})
        seen = mark["marks"][str(int(state["in_text"]))]
        keys = {level + state["level"]: (start, key) for level, start, key in seen["keys"]}
        coin, field = keys.get(COIN_LEVEL), keys.get(FIELD_LEVEL)
        state = dict(state, in_text=seen["inside"], level=state["level"] + seen["change"])
        if coin:
            state |= {"coin": coin[1], "field": None}
        if field and not (coin and field[0] < coin[0]):
            state["field"] = field[1]
    if state["in_text"] or state["level"] != 0:
        raise MalformedDocument(f"{marks[0]['range']['path']}: the document does not end where its file does")
    return out


def _number(value: object) -> float | None:
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, int | float):
        raise MalformedDocument(f"not a number: {str(value)[:40]!r}")
    return float(value)


def _millis(value: float | None) -> int | None:
    return int(value) if value is not None and abs(value) < 2.0**63 else None


def points(part: Range, state: dict, wanted: frozenset[str] | None) -> Iterator[pa.RecordBatch]:
    """(coin_id, timestamp_ms, price_usd) of the points that begin in a range."""
    length = part.stop - part.start
    while True:
        found = structure(part.data, state["in_text"], state["level"], part.escaped)
        opened = np.flatnonzero((found.kind == ord("[")) & (found.level == POINT_LEVEL))
        opened = opened[found.at[opened] < length]
        closed = np.flatnonzero((found.kind == ord("]")) & (found.level == POINT_LEVEL - 1))
        closed = closed[: len(opened)] if not len(opened) else closed[np.searchsorted(closed, opened[0]) :]
        if len(closed) >= len(opened) and (part.whole or not _last_quote_open(found, length)):
            break
        if part.whole:
            raise MalformedDocument("a point does not end")
        part.more()
    starts, ends = found.at[opened], found.at[closed[: len(opened)]] + 1
    # Stretches of points under one coin and field, cut at keys.
    stops = [(-1, state["coin"], state["field"])]
    coin = state["coin"]
    for start, end, level in found.keys(part.data):
        if level == COIN_LEVEL:
            coin = _text(part.data[start:end])
            stops.append((start, coin, None))
        elif level == FIELD_LEVEL:
            stops.append((start, coin, _text(part.data[start:end])))
    cuts = np.searchsorted(starts, [s for s, _, _ in stops[1:]]).tolist()
    for (_, coin, field), low, high in zip(stops, [0, *cuts], [*cuts, len(starts)], strict=True):
        if field != "prices" or (wanted is not None and coin not in wanted):
            continue
        for at in range(low, high, POINTS_AT_ONCE):
            until = min(high, at + POINTS_AT_ONCE)
            run = _parse(b"[" + part.data[starts[at] : ends[until - 1]] + b"]")
            if len(run) != until - at:
                raise MalformedDocument("points are not lists beside each other")
            millis = [_millis(_number(p[0]) if p else None) for p in run]
            prices = [_number(p[1]) if len(p) > 1 else None for p in run]
            columns = [pa.array([coin] * len(run), pa.string()), pa.array(millis, pa.int64())]
            columns.append(pa.array(prices, pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, ["coin_id", "timestamp_ms", "price_usd"])


def _parse(data: bytes) -> object:
    try:
        return json.loads(data)
    except ValueError as error:
        raise MalformedDocument(str(error)) from error


def _text(quoted: bytes) -> str:
    return _parse(quoted)


def texts(part: Range, state: dict, wanted: frozenset[str] | None) -> Iterator[pa.RecordBatch]:
    """(coin_id, description) of the keys that begin in a range."""
    length = part.stop - part.start
    while True:
        found = structure(part.data, state["in_text"], state["level"], part.escaped)
        keys = [k for k in found.keys(part.data) if k[2] == COIN_LEVEL]
        own = [k for k in keys if k[0] < length]
        # A value ends at the next comma on its level, or at the document's end.
        ends = found.at[
            ((found.kind == ord(",")) & (found.level == COIN_LEVEL)) | ((found.kind == ord("}")) & (found.level == 0))
        ]
        open_ = _last_quote_open(found, length) or (own and not (ends > own[-1][1]).any())
        if not open_ or part.whole:
            break
        part.more()
    out = []
    for start, end, _ in own:
        stop = np.searchsorted(ends, end)
        if stop == len(ends):
            raise MalformedDocument("a text does not end")
        (coin, text), = _parse(b"{" + part.data[start : ends[stop]] + b"}").items()
        if not (text is None or isinstance(text, str)):
            text = part.data[end : ends[stop]].partition(b":")[2].strip().decode()
        if wanted is None or coin in wanted:
            out.append((coin, text))
    columns = [pa.array([row[i] for row in out], pa.string()) for i in (0, 1)]
    yield pa.RecordBatch.from_arrays(columns, ["coin_id", "description"])


@dataclass
class BytePartition(InputPartition):
    """A byte range, and in the second pass where it stands."""

    place: dict

    def __init__(self, place: dict) -> None:
        super().__init__(place)
        self.place = place


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.kind = options["path"], options["kind"]
        self.step = int(options["range_bytes"])
        self.states = json.loads(options["states"]) if "states" in options else None
        self.wanted: frozenset[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Coins asked for by equality or a list are the only ones whose points are parsed."""
        for filter_ in filters:
            value = None
            if filter_ and getattr(filter_, "attribute", None) == ("coin_id",):
                if isinstance(filter_, EqualTo):
                    value = frozenset([filter_.value])
                elif isinstance(filter_, In):
                    value = frozenset(filter_.value)
            if value is None or self.states is None:
                yield filter_
            else:
                self.wanted = value if self.wanted is None else self.wanted & value

    def partitions(self) -> Sequence[BytePartition]:
        if self.states is not None:
            return [BytePartition(state) for state in self.states]
        return [
            BytePartition({"path": path, "start": start, "stop": min(size, start + self.step), "size": size})
            for path, size in list_files(self.path)
            for start in range(0, size, self.step)
        ]

    def read(self, partition: BytePartition) -> Iterator[pa.RecordBatch]:
        place = partition.place
        part = Range(place["path"], place["start"], place["stop"], place["size"])
        if self.states is None:
            row = {"path": place["path"], "start": place["start"], "stop": place["stop"]}
            row["marks"] = json.dumps({"size": place["size"], "marks": describe(part)})
            yield pa.RecordBatch.from_pylist([row])
        else:
            yield from (points if self.kind == "history" else texts)(part, place, self.wanted)


class DocumentRanges(DataSource):
    """Byte ranges of documents: their descriptions, or with ``states`` the rows that begin in them."""

    @classmethod
    def name(cls) -> str:
        return "document_ranges"

    def schema(self) -> str:
        if "states" not in self.options:
            return MARKS
        return HISTORY if self.options["kind"] == "history" else DESCRIPTIONS

    def reader(self, schema: object) -> _Reader:
        return _Reader(dict(self.options))
