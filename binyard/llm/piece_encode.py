"""Operator 11: SentencePiece encoding and decoding that keeps source offsets.

A text is normalised by the model's compiled character map: at each place the
longest prefix that the map's double-array trie knows is replaced, and every
byte of the result remembers the source byte that it came from.  Spaces become
the model's space sign, and a space sign is put in front.  The normalised text
is merged pair by pair, best score first, leftmost on ties (byte-pair
encoding); characters without a piece fall back to bytes.  Each piece is
projected back through the alignment to a range of bytes of the original
UTF-8 text; of the bytes of one character the last carries its range and the
others are empty ranges, as in the public library.

Merging is local: a symbol can only span two neighbouring characters if some
piece holds them side by side.  A text is therefore cut wherever no piece does,
and equal cuts are merged once per worker.  A map that is empty (the identity)
needs no walk: the alignment is then a count of the spaces before a place.

``encode`` is the general operator (ids and byte ranges per row), ``Pieces``
its worker-side model.  BPE models with byte fallback and no user-defined
pieces are supported; others are refused when the model is read.

Edge cases: a null or empty text has no pieces and decodes to the empty text;
a text of any length is encoded whole; null and repeated ids, ties and repeated
rows are rows like any other; an empty table gives no rows; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard.llm.common import ship

SPACE = "▁"
#: Encoded cuts that a worker remembers, characters of a short one (less than
#: 64), and how many of them are merged together.
CUTS = 1 << 19
LONG_CUT = 48
COLUMNS = 1 << 13
#: Characters that are cut at once; output rows are handed on as often.
WINDOW = 1 << 20

_NORMAL, _UNKNOWN, _CONTROL, _BYTE, _BPE = 1, 2, 3, 6, 2
_NEVER = 1 << 30


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7)
        size = varint() if size is None else size
        yield key >> 3, data[at : at + size]
        at += size


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 bytes whose
    values are places in a table of replacement texts."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.texts = blob[4 + size :]

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest known prefix of ``data[at:]`` and
        the prefix's length."""
        units, found = self.units, None
        node = self._child(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            unit = units[node]
            node ^= self._child(unit)
            if unit & 256:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        return self.texts[found[0] : self.texts.index(b"\0", found[0])], found[1]


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("one-each", _one_each)


class Normalizer:
    """Text to normalised text, with the source byte of every byte of it."""

    def __init__(self, spec: bytes) -> None:
        got = dict(_fields(spec))
        self.map = CharMap(got[2]) if got.get(2) else None
        self.prefix, self.squeeze, self.escape = bool(got.get(3, 1)), bool(got.get(4, 1)), bool(got.get(5, 1))
        self.sign = (SPACE if self.escape else " ").encode()
        self.plain = self.map is None and not self.squeeze and self.escape

    def __call__(self, text: str) -> tuple[str, Callable[[np.ndarray], np.ndarray] | None]:
        """(normalised text, normalised byte places to source byte places);
        None where each sign stands for one space and nothing else differs."""
        if not text:
            return "", lambda places: places
        if not self.plain:
            return self._walked(text.encode())
        if SPACE not in text:
            return (SPACE if self.prefix else "") + text.replace(" ", SPACE), None
        return self._counted(text)

    def _counted(self, text: str):
        out = text.replace(" ", SPACE)
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        spaces = np.flatnonzero(data == 0x20)
        spaces = spaces + 2 * np.arange(1, len(spaces) + 1)  # where the signs end, less one
        lead = 0
        if self.prefix:
            out, lead = SPACE + out, 3

        def source(places: np.ndarray) -> np.ndarray:
            places = np.maximum(places - lead, 0)
            return places - 2 * np.searchsorted(spaces, places, side="left")

        return out, source

    def _walked(self, data: bytes):
        out, came, at = bytearray(), [], 0
        space = self.squeeze  # spaces are swallowed at the start and after a space
        if self.prefix:
            out += self.sign
            came += [0] * len(self.sign)
        started = False
        while at < len(data):
            hit = self.map.longest(data, at) if self.map else None
            if hit is None:
                step = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                hit = data[at : at + step], step
            piece, step = hit
            if space:
                piece = piece.lstrip(b" ")
            if piece:
                if not started and self.squeeze and self.prefix:
                    came = [at] * len(came)  # swallowed spaces precede the sign
                started = True
                for byte in piece:
                    part = self.sign if byte == 0x20 else bytes((byte,))
                    out += part
                    came += [at] * len(part)
                space = self.squeeze and piece.endswith(b" ")
            at += step
        if self.squeeze:
            if not started:
                return "", lambda places: places
            while out.endswith(self.sign) and len(out) > 0:
                at = came[len(out) - len(self.sign)]
                del out[-len(self.sign) :], came[len(out) :]
        came = np.array([*came, at], dtype=np.int64)
        return out.decode(), lambda places: came[places]


class Pieces:
    """A model read from its file's bytes."""

    def __init__(self, model: bytes) -> None:
        pieces, trainer, normalizer = [], {}, b""
        for number, value in _fields(model):
            if number == 1:
                got = dict(_fields(value))
                pieces.append((got[1].decode(), struct.unpack("<f", got[2])[0] if 2 in got else 0.0, got.get(3, _NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = value
        kinds = {kind for _, _, kind in pieces}
        if trainer.get(3, 1) != _BPE or kinds != {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or trainer.get(24) or not trainer.get(35):
            raise ValueError("a BPE model is needed with normal, byte, control and unknown pieces and the space sign in front")
        self.normalize = Normalizer(normalizer)
        self.ids = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == _NORMAL}
        self.score = [score for _, score, _ in pieces]
        self.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == _UNKNOWN)
        self.bytes = {int(text[1:-1], 16): i for i, (text, _, kind) in enumerate(pieces) if kind == _BYTE}
        self.joined = {text[i : i + 2] for text in self.ids for i in range(len(text) - 1)}
        self.heads = not any(pair[0] != SPACE and pair[1] == SPACE for pair in self.joined)
        surface = trainer.get(44, " ⁇ ".encode()).decode()
        self.shown = ["" if kind == _CONTROL else surface if kind == _UNKNOWN else text.replace(SPACE, " ") for text, _, kind in pieces]
        self.byte_of = {i: b for b, i in self.bytes.items()}
        for b, i in self.bytes.items():
            if b < 0x80:  # stands for itself, whatever is beside it
                self.shown[i] = chr(b)
        self.part = np.zeros(len(pieces), dtype=bool)  # bytes that need their neighbours
        self.part[[i for b, i in self.bytes.items() if b >= 0x80]] = True
        self.control = {i for i, (_, _, kind) in enumerate(pieces) if kind == _CONTROL}
        self.cuts: dict[str, bytes] = {}
        self._tables(pieces)

    def _tables(self, pieces: list[tuple[str, float, int]]) -> None:
        """Symbols are the normal pieces, by id plus one, and after them the
        characters that only occur inside pieces; 0 is any other character.  A
        pair of symbols that forms a piece is known by its key."""
        best = sorted({score for _, score, _ in pieces}, reverse=True)
        place = {score: i for i, score in enumerate(best)}
        self.order = np.array([_NEVER >> 6] + [place[score] for _, score, _ in pieces], dtype=np.int32)
        #: text of a piece to its place in the order of merging
        self.rank = {text: place[self.score[i]] for text, i in self.ids.items() if len(text) > 1}
        symbol = {text: i + 1 for text, i in self.ids.items()}
        for char in sorted(set("".join(self.ids)) - set(symbol)):
            symbol[char] = max(len(pieces), *symbol.values()) + 1
        self.symbols = max(symbol.values(), default=0) + 1
        self.of_char = np.zeros(0x110000, dtype=np.int32)
        for text, at in symbol.items():
            if len(text) == 1:
                self.of_char[ord(text)] = at
        pairs = {}
        for text in self.rank:
            for i in range(1, len(text)):
                left, right = symbol.get(text[:i]), symbol.get(text[i:])
                if left is not None and right is not None:
                    pairs[left * self.symbols + right] = symbol[text]
        self.pair = np.array([*sorted(pairs), np.iinfo(np.int64).max], dtype=np.int64)
        self.pair_symbol = np.array([pairs[k] for k in self.pair[:-1].tolist()] + [0], dtype=np.int32)
        # of a byte: its character's, negative, on a first byte of several, else 0
        wide = {i: 1 if b < 0x80 else 0 if b < 0xC0 else -2 if b < 0xE0 else -3 if b < 0xF0 else -4 for b, i in self.bytes.items()}
        self.width = np.array([wide.get(i, len(text.encode())) for i, (text, _, _) in enumerate(pieces)], dtype=np.int32)
        self.byte_ids = np.array([self.bytes[b] for b in range(256)], dtype=np.int32)
        self.signs = np.array([text.count(SPACE) if kind == _NORMAL else 0 for text, _, kind in pieces], dtype=np.int32)
        inside = set("".join(self.joined))
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside)
        ahead: dict[str, set[str]] = {}
        for x, y in self.joined:
            ahead.setdefault(y, set()).add(x)
        # Marks that only other marks stand before within a piece: a cut ends
        # where one follows a character that is none.
        marks: set[str] = set()
        for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
            found, todo = {c}, [c]
            while todo:
                new = ahead.get(todo.pop(), set()) - found - {SPACE}
                found |= new
                todo += new
            if c in inside and not any(x.isascii() and x.isalnum() for x in found):
                marks |= found
        marks = "".join(map(re.escape, sorted(marks))) or alone or SPACE
        rest = f"[^{SPACE}{alone}{marks}]"
        self.words = re.compile((f"[{alone}]|" if alone else "") + f"{SPACE}+[{marks}]*{rest}*|[{marks}]+{rest}*|{rest}+")

    # ------------------------------------------------------------ encoding

    def _joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol that each pair of symbols forms, or 0."""
        key = left.astype(np.int64) * self.symbols + right
        at = np.searchsorted(self.pair, key)
        return np.where((self.pair[at] == key) & (left > 0) & (right > 0), self.pair_symbol[at], 0)

    def _learn(self, cuts: list[str]) -> None:
        """Merge short cuts, thousands at a time: a column is a cut, a row a
        place in it.  In every round each cut merges its best pair, and only
        the two pairs beside it are looked up again."""
        cuts.sort(key=len)
        chars = np.frombuffer("".join(cuts).encode("utf-32-le"), np.uint32)
        size = np.array([len(x) for x in cuts], dtype=np.int64)
        place = np.concatenate(([0], np.cumsum(size)))
        for a in range(0, len(cuts), COLUMNS):
            b = min(a + COLUMNS, len(cuts))
            n, own = int(size[b - 1]), size[a:b]
            filled = np.arange(n) < own[:, None]
            grid = np.zeros((b - a, n), dtype=np.uint32)
            grid[filled] = chars[place[a] : place[b]]
            alive = np.zeros((n + 1, b - a), dtype=bool)
            alive[:n] = filled.T
            # the last row, also reached as row -1, holds no symbol
            part = np.zeros((n + 1, b - a), dtype=np.int32)
            part[:n] = np.where(filled, self.of_char[grid], 0).T
            joined = np.zeros_like(part)
            joined[:n] = self._joins(part[:n].ravel(), part[1:].ravel()).reshape(n, b - a)
            row = np.arange(n + 1, dtype=np.int32)[:, None]
            order = np.where(joined > 0, self.order[np.minimum(joined, len(self.order) - 1)] << 6 | row, _NEVER)
            after, before = np.repeat(row + 1, b - a, axis=1), np.repeat(row - 1, b - a, axis=1)
            live = np.arange(b - a)
            while True:
                best = (order if len(live) == b - a else order[:, live]).min(axis=0)
                live, best = live[best < _NEVER], best[best < _NEVER]
                if not len(live):
                    break
                i = best & 63
                j = after[i, live]
                part[i, live] = joined[i, live]
                order[j, live] = _NEVER
                alive[j, live] = False
                k, h = after[j, live], before[i, live]
                after[i, live] = k
                before[np.minimum(k, n), live] = i
                for x, y in ((i, np.minimum(k, n)), (h, i)):
                    new = self._joins(part[x, live], part[y, live])
                    joined[x, live] = new
                    order[x, live] = np.where(new > 0, self.order[np.minimum(new, len(self.order) - 1)] << 6 | x, _NEVER)
            alive = alive[:n].T
            self._store(cuts[a:b], part[:n].T[alive], grid[alive], alive.sum(axis=1))

    def _store(self, cuts: list[str], symbols: np.ndarray, chars: np.ndarray, counts: np.ndarray) -> None:
        """Remember the cuts' ids; a character without a piece becomes its bytes."""
        lone = (symbols == 0) | (symbols > len(self.score))
        ids, size = symbols - 1, np.ones(len(symbols), dtype=np.int64)
        if lone.any():
            own = chars[lone]
            size[lone] = 1 + (own >= 0x80) + (own >= 0x800) + (own >= 0x10000)
            ids = np.repeat(ids, size)
            ids[np.repeat(lone, size)] = self.byte_ids[np.frombuffer("".join(map(chr, own.tolist())).encode(), np.uint8)]
        ends = (4 * np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(counts)))]).tolist()
        ids = ids.astype(np.int32).tobytes()
        self.cuts.update(zip(cuts, [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], strict=True))

    def _merge_long(self, text: str) -> list[str]:
        """The symbols left when no neighbours form a piece any more: with a
        heap, for cuts of any length."""
        part, rank = list(text), self.rank.get
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap = [(r, i, i + 1, x + y) for i, (x, y) in enumerate(zip(part, part[1:], strict=False)) if (r := rank(x + y, _NEVER)) < _NEVER]
        heapq.heapify(heap)
        while heap:
            _, a, b, both = heapq.heappop(heap)
            if not part[a] or not part[b] or part[a] + part[b] != both or after[a] != b:
                continue
            part[a], part[b] = both, ""
            after[a] = after[b]
            if after[a] < len(part):
                before[after[a]] = a
            for x, y in ((before[a], a), (a, after[a])):
                if x >= 0 and y < len(part) and (r := rank(part[x] + part[y], _NEVER)) < _NEVER:
                    heapq.heappush(heap, (r, x, y, part[x] + part[y]))
        return [x for x in part if x]

    def _cut(self, text: str) -> bytes:
        """The ids of a long cut, as an int32 buffer."""
        ids = []
        for symbol in self._merge_long(text):
            at = self.ids.get(symbol)
            ids += [self.bytes[b] for b in symbol.encode()] if at is None else [at]
        return array("i", ids).tobytes()

    def _know(self, cuts: set[str]) -> None:
        """Make ``self.cuts`` hold all of ``cuts``, without growing for ever."""
        new = {x for x in cuts if x not in self.cuts}
        if len(self.cuts) + len(new) > CUTS:
            self.cuts = {x: self.cuts[x] for x in cuts - new}
        self._add(new)

    def _add(self, new: set[str]) -> None:
        long = {x: self._apart(x) for x in new if len(x) > LONG_CUT}
        short = {y for parts in long.values() for y in parts if y not in self.cuts}
        self._learn([x for x in new | short if len(x) <= LONG_CUT])
        for x, parts in long.items():
            self.cuts[x] = b"".join([self.cuts[y] if len(y) <= LONG_CUT else self._cut(y) for y in parts])

    def _apart(self, text: str) -> list[str]:
        """``text`` cut between characters that no piece holds side by side."""
        out, a = [], 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in self.joined:
                out.append(text[a:i])
                a = i
        return [*out, text[a:]]

    def _windows(self, norm: str) -> Iterator[list[str]]:
        """The cuts of a normalised text, a bounded number at a time."""
        a = 0
        while a < len(norm):
            b = len(norm)
            if self.heads and b - a > WINDOW:  # up to a sign that starts a cut
                b = norm.find(SPACE, a + WINDOW)
                while 0 < b and norm[b - 1] == SPACE:
                    b = norm.find(SPACE, b + 1)
                b = b if b > 0 else len(norm)
            yield self.words.findall(norm[a:b]) if self.heads else self._apart(norm[a:b])
            a = b

    def encode_all(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, first source byte, end source byte) of the pieces of each
        text.  Texts of up to a window of characters are cut together."""
        a = 0
        while a < len(texts):
            b, size = a, 0
            while b < len(texts) and (b == a or size + len(texts[b] or "") <= WINDOW):
                size += len(texts[b] or "")
                b += 1
            norms = [self.normalize(x or "") for x in texts[a:b]]
            if b - a > 1:
                cuts = [next(self._windows(norm), []) if len(norm) <= WINDOW else None for norm, _ in norms]
                self._know({x for own in cuts if own for x in own})
            else:
                cuts = [None]
            for (norm, source), own in zip(norms, cuts, strict=True):
                yield self._encoded(norm, source, own)
            a = b

    def _encoded(self, norm, source, cuts):
        if cuts is None:
            found = []
            for own in self._windows(norm):
                self._know(set(own))
                found += map(self.cuts.__getitem__, own)
        else:
            found = map(self.cuts.__getitem__, cuts)
        ids = np.frombuffer(b"".join(found), np.int32)
        size = self.width[ids]
        head = np.flatnonzero(size < 0)  # the first byte of a character of several
        if len(head):
            wide = -size[head]
            size[head] = 0
            size[head + wide - 1] = wide
        empty = size == 0
        if source is None:  # every sign but the first is one space of the source
            end = np.cumsum(size - 2 * self.signs[ids], dtype=np.int64) - self.normalize.prefix
            start = np.concatenate(([0], end[:-1]))
            if len(ids) and not end[0]:
                start[1:2] = 0
        else:
            end = np.cumsum(size, dtype=np.int64)
            end, start = source(end), source(end - size)
        end[empty] = start[empty]  # bytes of a character before its last
        return ids, start[: len(ids)], end

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``encode_all`` of one text."""
        return next(self.encode_all([text]))

    # ------------------------------------------------------------ decoding

    def decode(self, ids) -> str:
        """The text of ids, as the public library gives it: one leading space
        goes where the model puts one in, runs of bytes are read as UTF-8 with
        U+FFFD for each byte that is none, control pieces are silent."""
        coded = np.asarray(ids, dtype=np.int64)
        ids = coded.tolist()
        skip = 0
        while skip < len(ids) and ids[skip] in self.control:
            skip += 1
        if skip == len(ids):
            return ""
        if skip:
            ids, coded = ids[skip:], coded[skip:]
        shown, part = self.shown, self.part[coded]
        if part.any():
            edge = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(ids)]
            out = []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if part[a]:
                    out.append(bytes([self.byte_of[i] for i in ids[a:b]]).decode("utf-8", "one-each"))
                else:
                    out.append("".join([shown[i] for i in ids[a:b]]))
            text = "".join(out)
        else:
            text = "".join([shown[i] for i in ids])
        first = ids[0] in self.byte_of
        if first or ids[0] == self.unknown:
            return text
        if self.normalize.squeeze:
            return text.lstrip(" ") if text[:1] == " " else text
        return text[1:] if self.normalize.prefix and text[:1] == " " else text


_MODELS: dict[bytes, Pieces] = {}


def pieces_of(model: bytes) -> Pieces:
    """The model, read once in a worker."""
    key = hashlib.sha256(model).digest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Pieces(model)
    return _MODELS[key]


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _rows(batches, columns: tuple[str, str], take, schema: pa.Schema):
    """Batches of (id, *what ``take`` gives for a list of values), of bounded
    size."""
    for batch in batches:
        keys, values = batch.column(columns[0]).to_pylist(), batch.column(columns[1])
        own, first, size = [], 0, 0
        for i in range(batch.num_rows):
            own.append(values[i].as_py())
            size += len(own[-1] or "") + 64
            if size >= WINDOW or i + 1 == batch.num_rows:
                yield _batch([(k, *x) for k, x in zip(keys[first : i + 1], take(own), strict=True)], schema)
                own, first, size = [], i + 1, 0


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _map(docs: DataFrame, model_path: str, make, spark_schema: str, schema: pa.Schema) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(_model_bytes(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _rows(batches, ("doc_id", "text"), make(pieces_of(model.value)), schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, spark_schema)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, starts, ends): the pieces of every text, and the range of
    its UTF-8 bytes that each covers."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
    return _map(docs, model_path, lambda model: model.encode_all, "doc_id long, ids array<int>, starts array<long>, ends array<long>", schema)


def decode(coded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids are no pieces."""
    spark = coded.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(_model_bytes(model_path))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces_of(model.value)
        yield from _rows(batches, ("doc_id", "ids"), lambda all_ids: ((own.decode(x or []),) for x in all_ids), schema)

    rows = coded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def _digest(model: Pieces):
    names = list(map(str, range(len(model.score))))

    def take(texts: list[str | None]) -> Iterator[tuple]:
        for ids, start, end in model.encode_all(texts):
            sha = hashlib.sha256(",".join([names[i] for i in ids.tolist()]).encode()).hexdigest()
            back = hashlib.sha256(model.decode(ids).encode()).hexdigest()
            spans = hashlib.sha256(start.astype("<i8").tobytes() + end.astype("<i8").tobytes()).hexdigest()
            yield len(ids), sha, back, spans, int((end - start).sum())

    return take


def op11(spark, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Every document's ids, encoded and decoded again, as digests; further
    the digest of the byte ranges and how many bytes they cover."""
    if model_path is None:
        import public_tokenizers
        model_path = public_tokenizers.path("piece_bpe_32k.model")
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
                        ("spans_sha256", pa.string()), ("covered_bytes", pa.int64())])
    return _map(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), model_path, _digest,
                "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string, covered_bytes long", schema)
