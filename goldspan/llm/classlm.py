"""Class-based n-gram language model: Brown classes by the exchange method.

The probability of a word is that of its class after the class before it, times
that of the word within its class. Texts are split once, into blocks: the
distinct words of a block, and its texts as numbers of these. The words of all
blocks meet in buckets, which count them. The exchange moves one of the most
frequent words at a time to the class that makes the counted pairs likeliest;
that only seeds the classes. Then every counted word goes to its best class by
the classes of its neighbours in all texts, in rounds: the blocks tell the
buckets what stands beside their words, the buckets tell the blocks the classes.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldspan.session import stored

HEAD = 1 << 17  # most frequent words: what the exchange and the driver see
MOVED = 1_024  # the most frequent of these: the exchange seeds the classes with them
CLASSES = 48
BANDS = (4_096, 16_384, 65_536)  # the exchange sees the other head words by rank, as neighbours only
ROUNDS = 6
MOVES = 2  # rounds over all words
FAR = CLASSES  # where words begin that stand next to no word of a class in the first round
STOPS = FAR + 1  # the end has a class of its own
ALL = STOPS + 1
UNSEEN = ALL  # words never seen: they come where words seen once do
NONE = 255  # no class yet
BACKOFF = 0.02  # weight of the class frequency against the class transition
END = b""  # no word is empty
BLOCK = 24 << 20  # bytes of text that are split together
BUCKET = 16 << 20  # bytes of text for each bucket of words


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, movable: int, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """The class of each symbol. ``pairs[a, b]``: how often b follows a; symbols from ``movable`` on keep a class of their own.

    Each movable symbol in turn goes to the class with the greatest likelihood
    of the pairs, ties to the smaller class, until a round moves none.
    """
    symbols = len(pairs)
    fixed = symbols - movable
    classes = min(classes, max(movable, 1))
    total = classes + fixed
    own = np.concatenate([np.arange(movable) % classes, classes + np.arange(fixed)])
    pairs = pairs.astype(np.float64)
    member = np.zeros((symbols, total))
    member[np.arange(symbols), own] = 1
    table = member.T @ pairs @ member
    after, before = pairs.sum(1), pairs.sum(0)
    start, end = member.T @ after, member.T @ before
    for _ in range(rounds):
        moves = 0
        for w in range(movable):
            a = own[w]
            out = np.bincount(own, pairs[w], total)  # to each class, without itself
            into = np.bincount(own, pairs[:, w], total)
            self_ = pairs[w, w]
            out[a] -= self_
            into[a] -= self_
            table[a] -= out
            table[:, a] -= into
            table[a, a] -= self_
            start[a] -= after[w]
            end[a] -= before[w]
            diagonal = np.arange(classes)
            rows = table[:classes]
            gain = (_xlogx(rows + out) - _xlogx(rows)).sum(1) + (_xlogx(table[:, :classes] + into[:, None]) - _xlogx(table[:, :classes])).sum(0)
            inner = table[diagonal, diagonal]
            gain += _xlogx(inner + out[:classes] + into[:classes] + self_) + _xlogx(inner) \
                - _xlogx(inner + out[:classes]) - _xlogx(inner + into[:classes])
            gain -= _xlogx(start[:classes] + after[w]) - _xlogx(start[:classes])
            gain -= _xlogx(end[:classes] + before[w]) - _xlogx(end[:classes])
            b = int(gain.argmax()) if gain.max() > gain[a] + 1e-9 else a
            table[b] += out
            table[:, b] += into
            table[b, b] += self_
            start[b] += after[w]
            end[b] += before[w]
            own[w] = b
            moves += b != a
        if not moves:
            break
    return own


@dataclass
class ClassModel:
    """What is collected: bounded by HEAD and CLASSES, whatever the corpus."""
    place: dict[bytes, int]  # head words (and the end) by falling count
    counts: np.ndarray
    class_of: np.ndarray  # of each head word
    transition: np.ndarray  # log10, by class
    in_class: np.ndarray  # tokens of each class
    tokens: int
    distinct: int

    @property
    def unseen(self) -> float:
        """Emission of a word never seen: as if there were as many of them as words seen, and one more."""
        return -math.log10(self.distinct + 1)


def _bands(places: np.ndarray) -> np.ndarray:
    """The symbol of head words by their place."""
    return np.where(places < MOVED, places, MOVED + np.searchsorted(BANDS, places, "right"))


SYMBOLS = MOVED + len(BANDS) + 2  # the bands, the end
STOP = SYMBOLS - 1
PARTS = 16  # of the table of symbol pairs


def _best(near: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The likeliest class of words. ``near[w]``: how often each class comes before (ALL numbers) and after it (ALL)."""
    logs = np.log(table[:ALL, :ALL] + 0.5)
    often = logs[:, :STOPS], logs[:STOPS].T
    after = np.log(table[:STOPS, :ALL].sum(1) + 0.5 * ALL)
    many = near.sum(1)
    gain = near[:, :ALL] @ often[0] + near[:, ALL:] @ often[1] - many[:, None] * after
    return np.where(many > 0, gain.argmax(1), FAR).astype(np.uint8)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on: their lowest bytes, the next ones and so on, compressed."""
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    planes = x.astype("<u4" if width <= 4 else "<u8").view(np.uint8).reshape(len(x), 4 if width <= 4 else 8)[:, :width].T
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    width, many = data[0], int.from_bytes(data[1:9], "little")
    kind = np.int32 if width < 4 else np.int64
    if not many:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.Codec("zstd", 1).decompress(data[9:], width * many, asbytes=True), np.uint8).reshape(width, many)
    x = planes[0].astype(kind)
    for i in range(1, width):
        x |= planes[i].astype(kind) << kind(8 * i)
    return x


def _rising(x: np.ndarray) -> bytes:
    """As ``_packed``, of numbers that do not fall."""
    return _packed(np.diff(x, prepend=x.dtype.type(0)))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _cuts(sorted_: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])).tolist() if len(sorted_) else []
    yield from zip(edges, [*edges[1:], len(sorted_)])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema) if rows \
        else pa.RecordBatch.from_pylist([], schema=schema)


def _fields(names: str) -> tuple[pa.Schema, str]:
    """Columns of numbers (bucket, block and so on) and packed ones, for Arrow and for Spark."""
    numbers = {"bucket", "block", "part", "c", "n"}
    return pa.schema([(x, pa.int64() if x in numbers else pa.binary()) for x in names.split()]), \
        ", ".join(f"{x} {'long' if x in numbers else 'binary'}" for x in names.split())


def _each(df: DataFrame, columns: str, make: Callable[[dict], Iterator[tuple]], to: str) -> DataFrame:
    """The rows that ``make`` gives for each row of ``df``."""
    schema, said = _fields(to)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _rows(list(make(batch.slice(i, 1).to_pylist()[0])), schema)

    return df.select(*columns.split()).mapInArrow(mapped, said)


def _met(left: DataFrame, right: DataFrame, key: str, make: Callable[[list[dict], list[dict]], Iterator[tuple]], to: str) -> DataFrame:
    """The rows that ``make`` gives for the rows of both that share ``key``."""
    schema, said = _fields(to)

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_rows(list(make(a.to_pylist(), b.to_pylist())), schema)])

    return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(meet, said)


def _block(number: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Texts as one row: each word as the number of its first appearance."""
    table = pa.Table.from_batches(batches).combine_chunks()
    ident, learns, text = (table.column(i).combine_chunks() for i in range(3))
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    words = lists.flatten()
    there = pc.greater(pc.binary_length(words), 0)  # none at white space at the ends
    kept = np.append(0, np.cumsum(there.to_numpy(zero_copy_only=False)))
    sizes = np.diff(kept[np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))])
    coded = words.filter(there).dictionary_encode()
    codes, learns = coded.indices.to_numpy(zero_copy_only=False), learns.to_numpy(zero_copy_only=False)
    counts = np.bincount(codes[np.repeat(learns, sizes)], minlength=len(coded.dictionary))
    one = {"block": number, "learned": int(learns.sum()), "bytes": pc.sum(pc.binary_length(text)).as_py() or 0}
    data = [_packed(learns), _packed(sizes), _packed(codes), _packed(counts), b" ".join(coded.dictionary.cast(pa.binary()).to_pylist())]
    return pa.RecordBatch.from_arrays(
        [*(pa.array([x], pa.int64()) for x in one.values()), *(pa.array([x], pa.binary()) for x in data),
         pa.ListArray.from_arrays(pa.array([0, len(ident)], pa.int32()), ident)],
        names=[*one, "learns", "sizes", "codes", "counts", "words", "idents"])


def _blocks(df: DataFrame, learns: Column, ident: str, text: str) -> DataFrame:
    """The texts in rows of about BLOCK bytes; a longer text has a row of its own. They are split here and nowhere else."""
    most = BLOCK

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ends = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + most - size, "right")) - 1)
                held.append(batch.slice(at, to - at))
                size += int(ends[to] - ends[at])
                at = to
                if at < batch.num_rows or size >= most:
                    yield _block(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield _block(number, held)

    made = "block long, learned long, bytes long, learns binary, sizes binary, codes binary, counts binary, words binary, " \
        f"idents array<{df.schema[ident].dataType.simpleString()}>"
    return stored(df.select(F.col(ident).alias("_ident"), F.coalesce(learns, F.lit(False)).alias("_learns"), F.col(text).alias("_text"))
                  .mapInArrow(split, made), "class-blocks")


def _dealt(words: list[bytes], buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of words by bucket, and of each bucket: it, and where its words begin and end in that order."""
    to = (_hashes(words) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    return order, [(int(to[order[a]]), a, b) for a, b in _cuts(to[order])]


def _sent(blocks: DataFrame, buckets: int) -> DataFrame:
    """The words of the blocks, for their buckets."""
    def send(row: dict) -> Iterator[tuple]:
        words, counts = row["words"].split(), _unpacked(row["counts"])
        order, cuts = _dealt(words, buckets)
        for bucket, a, b in cuts:
            at = order[a:b]
            yield bucket, row["block"], _rising(at), b" ".join([words[i] for i in at.tolist()]), _packed(counts[at])

    return _each(blocks, "block words counts", send, "bucket block at words counts")


def _merged(sent: DataFrame) -> DataFrame:
    """A row for each bucket, without ``block``: its words and their counts; and one for each block: which of these its words are."""
    schema, said = _fields("bucket block at idx words counts")

    def merge(table: pa.Table) -> pa.Table:
        place = defaultdict(count().__next__)
        rows, found, number = table.to_pylist(), [], []
        for row in rows:
            words = row["words"].split()
            found.append(np.fromiter(map(place.__getitem__, words), np.int64, len(words)))
            number.append(_unpacked(row["counts"]))
        counts = np.bincount(np.concatenate(found), np.concatenate(number), len(place)).astype(np.int64)
        out = [(row["bucket"], row["block"], row["at"], _packed(x), None, None) for row, x in zip(rows, found)]
        return pa.Table.from_batches([_rows([(rows[0]["bucket"], None, None, None, b" ".join(place), _packed(counts)), *out], schema)])

    return stored(sent.groupBy("bucket").applyInArrow(merge, said), "class-words")


@dataclass
class _Head:
    """The most frequent words by falling count and then by word, the end among them: where the others lie, and their hashes."""
    words: list[bytes]
    counts: np.ndarray
    bucket: np.ndarray  # -1: the end
    index: np.ndarray
    hashes: np.ndarray
    tokens: int
    distinct: int


def _head(words: DataFrame, docs: int) -> _Head:
    """Counts of counts tell what to collect; of the last ones, equally often, the first by word."""
    def numbers(row: dict) -> Iterator[tuple]:
        counts = _unpacked(row["counts"])
        yield from zip(*(x.tolist() for x in np.unique(counts[counts > 0], return_counts=True)))

    own = words.where("block is null")
    often = _each(own, "counts", numbers, "c n").groupBy("c").agg(F.sum("n").alias("n")).toPandas().sort_values("c", ascending=False)
    c, n = often["c"].to_numpy(np.int64), often["n"].to_numpy(np.int64)
    upto, room = np.cumsum(n), HEAD - 1
    whole = int(np.searchsorted(upto, room, "right"))
    least, left = (int(c[whole]), room - int(upto[whole - 1] if whole else 0)) if whole < len(c) else (0, 0)
    tied, slack = int(n[whole]) if left else 1, 20

    def chosen(row: dict) -> Iterator[tuple]:
        counts, all_ = _unpacked(row["counts"]), row["words"].split()
        last = sorted((all_[i], i) for i in np.flatnonzero(counts == least).tolist()) if left else []
        share = len(last) * left / tied  # words lie in buckets by hash: about that many of each, rather too many are sent
        sent = last[:int(share + 6 * math.sqrt(share)) + slack]
        at = np.append(np.flatnonzero(counts > least), [i for _, i in sent]).astype(np.int64)
        yield row["bucket"], _packed(at), b" ".join([all_[i] for i in at.tolist()]), _packed(counts[at]), sent[-1][0] if len(sent) < len(last) else None

    while True:
        found, short = [], []
        for row in _each(own, "bucket words counts", chosen, "bucket idx words counts last").collect():  # about HEAD words
            text = bytes(row["words"]).split()
            found += zip((-_unpacked(bytes(row["counts"])).astype(np.int64)).tolist(), text, [row["bucket"]] * len(text), _unpacked(bytes(row["idx"])).tolist())
            short += [bytes(row["last"])] if row["last"] is not None else []
        found = sorted(found)[:room]
        if not short or len(found) == room and min(short) >= found[-1][1]:
            break
        slack *= 8  # a bucket has more of them than it sent
    found = sorted([*found, (-docs, END, -1, -1)])
    return _Head([x[1] for x in found], np.array([-x[0] for x in found]), np.array([x[2] for x in found]), np.array([x[3] for x in found]),
                 _hashes([x[1] for x in found]), int((c * n).sum()) + docs, int(n.sum()) + 1)


def _known(words: list[bytes], hashes: np.ndarray, value: np.ndarray, none: int, end: int) -> np.ndarray:
    """The value of each word by its hash (``hashes`` rise), and that of the end behind them."""
    own = _hashes(words)
    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    return np.append(np.where(hashes[at] == own, value[at], none), end).astype(value.dtype)


def _line(row: dict, learned: bool) -> np.ndarray:
    """A block's texts in a row, an end (the number behind those of the words) before and after each."""
    sizes, codes, learns = _unpacked(row["sizes"]), _unpacked(row["codes"]), _unpacked(row["learns"]) > 0
    many = len(_unpacked(row["counts"]))
    if learned and not learns.all():
        sizes, codes = sizes[learns], codes[np.repeat(learns, sizes)]
    line = np.full(len(codes) + len(sizes) + 1, many, np.int32)
    line[np.arange(1, len(codes) + 1, dtype=np.int32) + np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)] = codes
    return line


def _seen(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How often a class stands before another."""
    at = (left != NONE) & (right != NONE)
    code = left[at].astype(np.int32) * (ALL + 1) + right[at]
    return np.bincount(code, minlength=(ALL + 1) ** 2).astype(np.float64).reshape(ALL + 1, ALL + 1)


def _beside(row: dict, classes: np.ndarray, order: np.ndarray, cuts: list[tuple[int, int, int]], buckets: int) -> Iterator[tuple]:
    """What a block tells the buckets: how often a class stands before (ALL numbers) and after (ALL) their words, and before another class."""
    line, many = _line(row, True), len(order)
    rank = np.zeros(many + 1, np.int32 if many < 20_000_000 else np.int64)
    rank[order] = np.arange(many)
    own = classes[line]
    a, b = (own[1:] != NONE) & (line[:-1] != many), (own[:-1] != NONE) & (line[1:] != many)
    code = np.concatenate([rank[line[:-1][a]] * (2 * ALL) + (ALL + own[1:][a].astype(np.int32)), rank[line[1:][b]] * (2 * ALL) + own[:-1][b].astype(np.int32)])
    code, n = np.unique(code, return_counts=True)
    yield row["block"] % buckets, row["block"], None, None, _seen(own[:-1], own[1:]).tobytes()
    for bucket, x, y in cuts:
        i, j = np.searchsorted(code, (x * 2 * ALL, y * 2 * ALL))
        if i < j:
            yield bucket, row["block"], _rising(code[i:j] - x * 2 * ALL), _packed(n[i:j]), None


BESIDE = "bucket block codes numbers seen"


def _gather(words: DataFrame, beside: DataFrame) -> DataFrame:
    """Of each bucket: what stands beside its words (word, class and side as one number; how often), and the class pairs it was told."""
    def gather(own: list[dict], told: list[dict]) -> Iterator[tuple]:
        index = {row["block"]: row for row in own}
        codes, numbers, seen = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros((ALL + 1) ** 2)
        for row in told:
            if row["seen"] is not None:
                seen += np.frombuffer(row["seen"])
            else:
                code = _risen(row["codes"])
                codes.append(_unpacked(index[row["block"]]["idx"]).astype(np.int64)[code // (2 * ALL)] * (2 * ALL) + code % (2 * ALL))
                numbers.append(_unpacked(row["numbers"]))
        code, n = np.concatenate(codes), np.concatenate(numbers)
        order = np.argsort(code)
        code, n = code[order], n[order]
        start = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
        yield ((own or told)[0]["bucket"], index[None]["counts"] if own else _packed(n[:0]), _rising(code[start]),
               _packed(np.add.reduceat(n, start) if len(n) else n), seen.tobytes())

    return stored(_met(words.select("bucket", "block", "idx", "counts"), beside, "bucket", gather, "bucket counts codes numbers seen"), "class-round")


def _moved(gathered: DataFrame, table: np.ndarray) -> DataFrame:
    """The class of every word of a bucket."""
    def move(row: dict) -> Iterator[tuple]:
        counts, code, n = _unpacked(row["counts"]), _risen(row["codes"]), _unpacked(row["numbers"])
        classes = np.full(len(counts), UNSEEN, np.uint8)
        for a in range(0, len(counts), 20_000):  # bounds the dense table
            i, j = np.searchsorted(code, (a * 2 * ALL, (a + 20_000) * 2 * ALL))
            near = np.zeros((len(counts[a:a + 20_000]), 2 * ALL))
            near.reshape(-1)[code[i:j] - a * 2 * ALL] = n[i:j]
            classes[a:a + 20_000] = np.where(counts[a:a + 20_000] > 0, _best(near, table), UNSEEN)
        yield row["bucket"], row["counts"], _packed(classes)

    return stored(_each(gathered, "bucket counts codes numbers", move, "bucket counts classes"), "classes")


def _tell(words: DataFrame, state: DataFrame) -> DataFrame:
    """What the buckets tell the blocks: count and class of each of their words."""
    def tell(own: list[dict], states: list[dict]) -> Iterator[tuple]:
        counts, classes = _unpacked(states[0]["counts"]), _unpacked(states[0]["classes"])
        for row in own:
            index = _unpacked(row["idx"])
            yield row["block"], row["bucket"], row["at"], _packed(counts[index]), _packed(classes[index])

    return _met(words.where("block is not null").select("bucket", "block", "at", "idx"), state, "bucket", tell, TOLD)


TOLD = "block bucket at counts classes"


def _told(row: dict, told: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Counts and classes of a block's words, the end's class behind them; the order of words by bucket and the buckets."""
    many = len(_unpacked(row["counts"]))
    counts, classes, order, cuts, end = np.zeros(many, np.int64), np.full(many + 1, UNSEEN, np.uint8), [np.zeros(0, np.int64)], [], 0
    classes[many] = STOPS
    for x in told:
        order.append(_risen(x["at"]))
        counts[order[-1]], classes[order[-1]] = _unpacked(x["counts"]), _unpacked(x["classes"])
        cuts.append((x["bucket"], end, end + len(order[-1])))
        end += len(order[-1])
    return counts, classes, np.concatenate(order), cuts


def _lines(blocks: DataFrame, told: DataFrame, docs: int, kind: str) -> DataFrame:
    """Each block's texts as classes, what their scores need besides the model, and the class pairs of those learned from."""
    def closed(a: pa.Table, b: pa.Table) -> pa.Table:
        row = a.drop_columns(["idents"]).to_pylist()[0]
        counts, classes, _, _ = _told(row, b.to_pylist())
        line, own = _line(row, True), classes.astype(np.int16)
        once = np.append(counts == 1, docs == 1)
        left, right, no = own[line[:-1]], own[line[1:]], np.int16(NONE)
        seen = _seen(left, right) + _seen(np.where(once[line[:-1]], np.int16(UNSEEN), no), right) * (np.arange(ALL + 1) == UNSEEN)[:, None] \
            + _seen(left, np.where(once[line[1:]], np.int16(UNSEEN), no)) * (np.arange(ALL + 1) == UNSEEN)
        sizes, codes = _unpacked(row["sizes"]), _unpacked(row["codes"])
        text = np.repeat(np.arange(len(sizes)), sizes)
        sums = [np.bincount(text, x[codes], len(sizes)) for x in (counts > 0, np.log10(counts + 1), np.log10(np.maximum(counts, 1)))]
        data = [row["sizes"], *(x.tobytes() for x in sums), _packed(classes[_line(row, False)]), seen.tobytes()]
        return pa.table([*(pa.array([x], pa.binary()) for x in data), a.column("idents")], names=["sizes", "known", "base", "within", "line", "seen", "idents"])

    return stored(blocks.select("block", "learns", "sizes", "codes", "counts", "idents").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        closed, f"sizes binary, known binary, base binary, within binary, line binary, seen binary, idents array<{kind}>"), "class-lines")


def _added(df: DataFrame, column: str, size: int) -> np.ndarray:
    """The sum of small tables."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((np.frombuffer(x) for batch in batches for x in batch.column(0).to_pylist()), np.zeros(size))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["seen"])

    return sum((np.frombuffer(x["seen"]) for x in df.select(column).mapInArrow(add, "seen binary").collect()), np.zeros(size))  # one per task


def _seeds(blocks: DataFrame, head: _Head) -> np.ndarray:
    """The classes of the MOVED most frequent words, by the exchange."""
    symbol = _bands(np.arange(len(head.words)))
    order = np.argsort(head.hashes)
    hashes, symbols = head.hashes[order], symbol[order].astype(np.int32)
    step = -(-SYMBOLS * SYMBOLS // PARTS)

    def pairs(row: dict) -> Iterator[tuple]:
        own = _known(row["words"].split(), hashes, symbols, -1, STOP)[_line(row, True)]
        at = (own[:-1] >= 0) & (own[1:] >= 0)
        table = np.bincount(own[:-1][at] * SYMBOLS + own[1:][at], minlength=step * PARTS)
        for part in range(PARTS):
            used = np.flatnonzero(table[part * step:(part + 1) * step])
            yield part, _rising(used), _packed(table[used + part * step])

    schema, said = _fields("part codes numbers")

    def add(table: pa.Table) -> pa.Table:
        rows, total = table.to_pylist(), np.zeros(step, np.int64)
        for row in rows:
            total[_risen(row["codes"])] += _unpacked(row["numbers"])
        used = np.flatnonzero(total)
        return pa.Table.from_batches([_rows([(rows[0]["part"], _rising(used), _packed(total[used]))], schema)])

    table = np.zeros(step * PARTS)
    sums = _each(blocks, "learns sizes codes counts words", pairs, "part codes numbers").groupBy("part").applyInArrow(add, said)
    for row in sums.collect():  # SYMBOLS squared numbers at most
        table[_risen(bytes(row["codes"])) + row["part"] * step] = _unpacked(bytes(row["numbers"]))
    return exchange(table[:SYMBOLS * SYMBOLS].reshape(SYMBOLS, SYMBOLS), MOVED, CLASSES)[:min(MOVED, len(head.words))]


def _buckets(df: DataFrame, size: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET)


def _fit(blocks: DataFrame, kind: str) -> tuple[ClassModel, DataFrame, DataFrame, DataFrame, _Head | None]:
    """The model, the blocks' texts as classes, the buckets of words, their classes, and the head."""
    docs, size = (x or 0 for x in blocks.agg(F.sum("learned"), F.sum("bytes")).first())
    buckets = _buckets(blocks, size)
    words = _merged(_sent(blocks, buckets))
    if not docs:
        def unseen(row: dict) -> Iterator[tuple]:
            yield row["bucket"], row["counts"], _packed(np.full(len(_unpacked(row["counts"])), UNSEEN))

        state = _each(words.where("block is null"), "bucket counts", unseen, "bucket counts classes")
        return ClassModel({}, np.zeros(0, np.int64), np.zeros(0, np.uint8), np.full((ALL + 1, ALL + 1), -math.log10(ALL + 1)), np.zeros(ALL + 1), 0, 0), \
            _lines(blocks, _tell(words, state), 0, kind), words, state, None
    head = _head(words, docs)
    moved = _seeds(blocks, head)
    order = np.argsort(head.hashes[:len(moved)])
    hashes, seeds = head.hashes[order], moved[order].astype(np.uint8)

    def first(row: dict) -> Iterator[tuple]:
        own = row["words"].split()
        yield from _beside(row, _known(own, hashes, seeds, NONE, STOPS), *_dealt(own, buckets), buckets)

    def later(own: list[dict], told: list[dict]) -> Iterator[tuple]:
        _, classes, order, cuts = _told(own[0], told)
        yield from _beside(own[0], classes, order, cuts, buckets)

    for i in range(MOVES):
        if i:
            beside = _met(blocks.select("block", "learns", "sizes", "codes", "counts"), _tell(words, state), "block", later, BESIDE)
        else:
            beside = _each(blocks, "block learns sizes codes counts words", first, BESIDE)
        gathered = _gather(words, beside)
        state = _moved(gathered, _added(gathered, "seen", (ALL + 1) ** 2).reshape(ALL + 1, ALL + 1))
    lines = _lines(blocks, _tell(words, state), docs, kind)
    table = _added(lines, "seen", (ALL + 1) ** 2).reshape(ALL + 1, ALL + 1) + 0.5  # half a pair more each, so that none is impossible
    often = table.sum(0) / table.sum()
    transition = np.log10((1 - BACKOFF) * table / table.sum(1, keepdims=True) + BACKOFF * often)
    places = {b: np.flatnonzero(head.bucket == b) for b in np.unique(head.bucket).tolist()}
    index = {b: head.index[x] for b, x in places.items()}

    def told(row: dict) -> Iterator[tuple]:
        classes = _unpacked(row["classes"])
        yield row["bucket"], classes[index.get(row["bucket"], np.zeros(0, np.int64))].astype(np.uint8).tobytes(), \
            np.bincount(classes, _unpacked(row["counts"]), ALL + 1).tobytes()

    class_of, in_class = np.full(len(head.words), STOPS, np.uint8), np.zeros(ALL + 1)
    in_class[STOPS] = docs
    for row in _each(state, "bucket counts classes", told, "bucket classes seen").collect():  # HEAD classes at most, a small table each
        class_of[places.get(row["bucket"], np.zeros(0, np.int64))] = np.frombuffer(row["classes"], np.uint8)
        in_class += np.frombuffer(row["seen"])
    model = ClassModel({w: i for i, w in enumerate(head.words)}, head.counts, class_of, transition, in_class, head.tokens, head.distinct)
    return model, lines, words, state, head


def train(df: DataFrame, learns: Column, ident: str = "doc_id", text: str = "text") -> tuple[ClassModel, DataFrame]:
    """The model of the texts where ``learns`` holds, and their words beyond the head (``word``, ``c``) with their ``class``."""
    model, _, words, state, head = _fit(_blocks(df.where(learns), F.lit(True), ident, text), df.schema[ident].dataType.simpleString())
    index = {b: head.index[head.bucket == b] for b in np.unique(head.bucket).tolist()} if head else {}

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts, classes, all_ = _unpacked(row["counts"]), _unpacked(row["classes"]), row["words"].split()
                rare = counts > 0
                rare[index.get(row["bucket"], np.zeros(0, np.int64))] = False
                at = np.flatnonzero(rare)
                yield pa.RecordBatch.from_arrays([pa.array([all_[i] for i in at.tolist()], pa.binary()), pa.array(counts[at], pa.int64()),
                                                  pa.array(classes[at], pa.int32())], names=["word", "c", "class"])

    both = words.where("block is null").select("bucket", "words").join(state, "bucket").select("bucket", "words", "counts", "classes")
    return model, both.mapInArrow(listed, "word binary, c long, class int")


def _answers(blocks: DataFrame, model: ClassModel, classed: DataFrame, buckets: int) -> DataFrame:
    """What a model trained on other texts tells the blocks."""
    spark, schema = blocks.sparkSession, "bucket long, words binary, counts binary, classes binary"
    heads = spark.createDataFrame([(bytearray(w), int(model.counts[i]), int(model.class_of[i])) for w, i in model.place.items() if w],
                                  "word binary, c long, class int")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = _fields("bucket words counts classes")[0]
        for batch in batches:
            words, c, of = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            order, cuts = _dealt(words, buckets)
            yield _rows([(x, b" ".join([words[i] for i in order[a:b].tolist()]), _packed(c[order[a:b]]), _packed(of[order[a:b]])) for x, a, b in cuts], fields)

    def answer(asked: list[dict], known: list[dict]) -> Iterator[tuple]:
        place = {w: i for i, w in enumerate(w for row in known for w in row["words"].split())}
        counts = np.concatenate([*(_unpacked(row["counts"]) for row in known), [0]])
        classes = np.concatenate([*(_unpacked(row["classes"]) for row in known), [UNSEEN]])
        for row in asked:
            index = np.array([place.get(w, len(place)) for w in row["words"].split()], np.int64)
            yield row["block"], row["bucket"], row["at"], _packed(counts[index]), _packed(classes[index])

    packed = classed.select("word", "c", "class").unionByName(heads).mapInArrow(pack, schema)
    return _met(_sent(blocks, buckets).drop("counts"), packed, "bucket", answer, TOLD)


def _scored(lines: DataFrame, model: ClassModel, ident: str, kind: str) -> DataFrame:
    """Both scores of every text. A class's part of a word's emission goes with the transition to it."""
    known = END in model.place
    within = np.zeros(ALL + 1)
    used = model.in_class > 0
    within[used] = -np.log10(model.in_class[used])
    within[STOPS], within[UNSEEN] = 0.0, model.unseen  # the end is all of its class
    step, every = (model.transition + within).reshape(-1), math.log10(model.tokens + model.distinct + 1)
    ends = math.log10(int(model.counts[model.place[END]]) + 1) if known else 0.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                sizes, line = _unpacked(row.column("sizes")[0].as_py()), _unpacked(row.column("line")[0].as_py())
                found, base, in_ = (np.frombuffer(row.column(x)[0].as_py()) for x in ("known", "base", "within"))
                sums = np.add.reduceat(step[line[:-1] * (ALL + 1) + line[1:]], np.append(0, np.cumsum(sizes + 1)[:-1]))
                idents = row.column("idents").flatten()
                yield pa.RecordBatch.from_arrays(
                    [idents, pa.array(sizes + 1, pa.int64()), pa.array(found + known, pa.int64()), pa.array(base + ends - every * (sizes + 1), pa.float64()),
                     pa.array(in_ + sums, pa.float64())], names=[ident, "n_tokens", "n_known", "base_score", "score"])

    return lines.drop("seen").mapInArrow(score, f"`{ident}` {kind}, n_tokens long, n_known long, base_score double, score double")


def score_texts(df: DataFrame, model: ClassModel, classed: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``ident``, ``n_tokens``, ``n_known``, ``base_score``, ``score`` (log10) of every whole text, its end included."""
    kind, blocks = df.schema[ident].dataType.simpleString(), _blocks(df, F.lit(False), ident, text)
    buckets = max(_buckets(blocks, blocks.agg(F.sum("bytes")).first()[0] or 0), model.distinct // 200_000)
    return _scored(_lines(blocks, _answers(blocks, model, classed, buckets), 0, kind), model, ident, kind)


def scores(df: DataFrame, parts: int = 7, held: int = 2) -> DataFrame:
    """``doc_id``, ``held_out``, token counts and both scores of every text, learned from those not held out.

    A text's tokens are its words, A-Z in lower case, and an end; a null text has
    the end only. Held out: crc32 of the id as text is ``held`` modulo ``parts``;
    a row without id is not held out. Repeated rows count and score as often as
    they occur. With nothing to learn from all words are unknown. An empty table
    gives an empty result; other columns are not used.
    """
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts
    held_out = F.coalesce(part == held, F.lit(False))
    kind = df.schema["doc_id"].dataType.simpleString()
    model, lines, *_ = _fit(_blocks(df, ~held_out, "doc_id", "text"), kind)
    return _scored(lines, model, "doc_id", kind).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")
