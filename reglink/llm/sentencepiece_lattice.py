"""SentencePiece encoding and decoding over a relational lattice.

1. A text is normalised (a blank becomes the mark, one mark goes before the text) and falls into
   units, each beginning with its marks; no piece reaches from one unit into the next.
2. Every distinct unit of the corpus is exploded into its substrings of at most the longest
   piece's length; an equi-join to the piece table (as long as the vocabulary, so broadcast)
   leaves the lattice's edges, which are grouped by unit.  Units are partitioned before the
   explosion, so edges aren't shuffled.
3. A higher-order ``aggregate`` folds a unit's edges into its pieces: for a unigram model the
   Viterbi path (best sum of scores; ties: fewer pieces, then the longer last piece), for a BPE
   model the merges in the order of their scores, which is what such a model means.
   Characters without a piece become byte pieces.  For whole corpora and BPE, ``merge_edges`` replays the
   same merges in numpy for all units of a bucket at once: the same ids at a fraction of the cost.
4. Text groups ask for their distinct units' ids, packed per bucket (see ``exchange``), and put
   their documents together.

Decoding joins the pieces' bytes, turns marks into blanks and drops the one before the text.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import exchange as ex

MARK = "▁"
MARK_BYTES = MARK.encode()
UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
MAX_UNIT = 256           # longer units are folded outside the lattice, by the same merges
GROUP_BYTES = 8 << 20
BUCKET_UNITS = 1 << 15
START, SIZE = 1 << 40, 1 << 32       # an edge is start * START + size * SIZE + what it stands for

UNITS = "_g int, b int, units binary"
PLACED = "b int, u int, unit string"
FOLDED = "b int, sizes binary, ids binary"
REPLY = "_g int, b int, sizes binary, ids binary"


@dataclass(frozen=True)
class Model:
    """Pieces of a model by id; ``bytes_from`` is the id of byte piece 0 (-1: none)."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    unknown: int
    bytes_from: int
    bpe: bool

    @property
    def longest(self) -> int:
        return max((len(p) for p, n in zip(self.pieces, self.normal) if n), default=1)

    def bytes_of(self) -> list[bytes]:
        """Bytes that each id stands for."""
        out = [p.encode() if n else b"" for p, n in zip(self.pieces, self.normal)]
        if self.bytes_from >= 0:
            out[self.bytes_from:self.bytes_from + 256] = [bytes([i]) for i in range(256)]
        return out


def load_model(path: str, bpe: bool = True) -> Model:
    """Read a ``.model`` file.  ``bpe`` says which kind it is, as the library doesn't."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.piece_size()
    normal = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
    first = next((i for i in range(n) if sp.is_byte(i)), -1)
    return Model([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)], normal, sp.unk_id(), first, bpe)


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """(piece, piece_id, score) of the pieces that text can match."""
    rows = [(p, i, float(s)) for i, (p, s, ok) in enumerate(zip(model.pieces, model.scores, model.normal)) if ok]
    return spark.createDataFrame(rows, "piece string, piece_id int, score double")


def lattice(units: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(b, unit, edges): each unit's edges (start, size, score, piece_id) as an array sorted by start and
    size; an edge of one character is there even without a piece (null id)."""
    placed = units.repartition("unit", "b")
    start = placed.select("b", "unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("start"))
    most = F.least(F.lit(longest), F.length("unit") - F.col("start"))
    span = start.select("b", "unit", "start", F.explode(F.sequence(F.lit(1), most)).alias("size"))
    span = span.withColumn("piece", F.substring("unit", F.col("start") + 1, F.col("size")))
    edges = span.join(F.broadcast(pieces), "piece", "left").where(F.col("piece_id").isNotNull() | (F.col("size") == 1))
    return edges.groupBy("unit", "b").agg(F.sort_array(F.collect_list(F.struct("start", "size", "score", "piece_id"))).alias("edges"))


def _key(start: Column, size: Column, longest: int) -> Column:
    return start * (longest + 1) + size


def bpe_bounds(longest: int) -> Column:
    """Piece bounds of ``unit`` by replaying merges: of all neighbours whose join is a piece, the
    best-scored (leftmost of equals) become one, until none can."""
    seen = F.map_from_arrays(F.transform("joins", lambda e: _key(e["start"], e["size"], longest)), F.transform("joins", lambda e: e["score"]))
    first = F.sequence(F.lit(0), F.length("unit"))

    def merge(b: Column, _: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(b) - 2)

        def score(i: Column) -> Column:
            size = F.get(b, i + 1) - F.get(b, i - 1)
            return F.when(size <= longest, F.try_element_at(F.col("seen"), _key(F.get(b, i - 1), size, longest)))

        best = F.array_max(F.filter(F.transform(at, lambda i: F.struct(score(i).alias("s"), (-i).alias("i"))), lambda x: x["s"].isNotNull()))
        cut = F.transform(F.array(best), lambda x: F.filter(b, lambda _v, i: x["i"].isNull() | (i != -x["i"])))
        return F.when(F.size(b) > 2, F.get(cut, F.lit(0))).otherwise(b)

    # each merge takes a join's edge and a bound: at most so many
    most = F.greatest(F.lit(1), F.least(F.size("joins"), F.length("unit") - 1))
    return seen, F.aggregate(F.sequence(F.lit(1), most), first, merge)


def viterbi_bounds(unknown_score: float) -> Column:
    """Piece bounds of ``unit`` on the best path: the fold's state holds, per place, the best score, the
    pieces so far and where the last piece began."""
    start = F.array(F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"), F.lit(0).alias("p")))

    def step(best: Column, end: Column) -> Column:
        ways = F.transform(F.filter(F.col("edges"), lambda e: e["start"] + e["size"] == end), lambda e: F.struct(
            (F.get(best, e["start"])["s"] + F.coalesce(e["score"], F.lit(unknown_score))).alias("s"),
            (F.get(best, e["start"])["n"] - 1).alias("n"), (-e["start"]).alias("q")))
        top = F.array_min(F.transform(ways, lambda w: F.struct((-w["s"]).alias("s"), (-w["n"]).alias("n"), (-w["q"]).alias("q"))))
        return F.concat(best, F.transform(F.array(top), lambda t: F.struct((-t["s"]).alias("s"), (-t["n"]).alias("n"), t["q"].alias("p"))))

    best = F.aggregate(F.sequence(F.lit(1), F.length("unit")), start, step)
    return F.aggregate(F.sequence(F.lit(1), F.length("unit")), F.array(F.length("unit")),
                       lambda b, _: F.when(F.get(b, F.lit(0)) > 0, F.concat(F.array(F.get(F.col("best"), F.get(b, F.lit(0)))["p"]), b)).otherwise(b)), best


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once a row: read inside a lambda, a plain projection's expression
    would be computed again for every element, so each passes through a generator."""
    made = df.withColumn("_once", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
    return made.select(*df.columns, *[F.col(f"_once.{n}").alias(n) for n in columns])


def fold(edges: DataFrame, model: Model) -> DataFrame:
    """(b, unit, ids): the pieces of each unit of a lattice."""
    longest = model.longest
    if model.bpe:
        seen, bounds = bpe_bounds(longest)
        held = _once(edges, joins=F.filter("edges", lambda e: e["size"] > 1))
        held = _once(_once(held, seen=seen), bounds=bounds)
    else:
        bounds, best = viterbi_bounds(min(model.scores) - 10.0)
        held = _once(_once(edges, best=best), bounds=bounds)
    ids = F.map_from_arrays(F.transform("edges", lambda e: _key(e["start"], e["size"], longest)), F.transform("edges", lambda e: F.coalesce(e["piece_id"], F.lit(-1))))

    def piece(i: Column) -> Column:
        begin, size = F.get(F.col("bounds"), i - 1), F.get(F.col("bounds"), i) - F.get(F.col("bounds"), i - 1)
        own = F.element_at(F.col("piece_ids"), _key(begin, size, longest))
        if model.bytes_from < 0:
            return F.array(F.when(own < 0, F.lit(model.unknown)).otherwise(own))
        code = F.hex(F.substring("unit", begin + 1, F.lit(1)).cast("binary"))
        fallback = F.transform(F.sequence(F.lit(1), F.length(code) - 1, F.lit(2)),
                               lambda j: F.conv(F.substring(code, j, F.lit(2)), 16, 10).cast("int") + F.lit(model.bytes_from))
        return F.when(own >= 0, F.array(own)).otherwise(fallback)

    held = _once(held, piece_ids=ids)
    return held.select("b", "unit", F.flatten(F.transform(F.sequence(F.lit(1), F.size("bounds") - 1), piece)).alias("ids"))


def encode_units(units: DataFrame, model: Model, pieces: DataFrame) -> DataFrame:
    """(b, unit, ids) of distinct (b, unit) rows; no unit is empty."""
    return fold(lattice(units, pieces, model.longest), model)


def edge_rows(units: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(b, u, edge): the lattice's edges of every unit (b, u, unit), one number each: its start and size, and twice its
    piece's id, or for a character without a piece twice its code point and one."""
    start = units.select("b", "u", "unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("start"))
    most = F.least(F.lit(longest), F.length("unit") - F.col("start"))
    span = start.select("b", "u", "start", F.substring("unit", F.col("start") + 1, F.lit(longest)).alias("rest"), F.explode(F.sequence(F.lit(1), most)).alias("size"))
    span = span.select("b", "u", "start", "size", F.substring("rest", F.lit(1), F.col("size")).alias("piece"))
    edges = span.join(F.broadcast(pieces.select("piece", "piece_id")), "piece", "left").where(F.col("piece_id").isNotNull() | (F.col("size") == 1))
    # the code point of a character, from its UTF-32 bytes
    point = F.conv(F.hex(F.encode(F.col("piece"), "UTF-32")), 16, 10).cast("long")
    what = F.when(F.col("piece_id").isNotNull(), F.col("piece_id").cast("long") * 2).otherwise(point * 2 + 1)
    return edges.select("b", "u", (F.col("start") * F.lit(START) + F.col("size") * F.lit(SIZE) + what).alias("edge"))


def merge_edges(u: np.ndarray, edge: np.ndarray, scores: np.ndarray, n_units: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges of all units at once: (unit, edge's meaning) of the pieces in order, and each unit's number of pieces.

    ``cell`` holds what each (character, size) of the units laid end to end stands for.  A round finds in every unit
    that still merges the best-scored neighbours (leftmost of equals) and joins them."""
    start, size, what = edge // START, edge // SIZE % (START // SIZE), edge % SIZE
    length = np.zeros(n_units, np.int64)
    one = size == 1
    np.add.at(length, u[one], 1)
    base = np.concatenate(([0], np.cumsum(length)))
    cell = np.full((int(base[-1]), longest), -1, np.int64)
    cell[base[u] + start, size - 1] = what
    score = np.concatenate([scores, [-np.inf]])
    # joins of characters without a piece are none; -1 finds the last score
    begin = np.arange(int(base[-1]))                     # where the current pieces begin, of units that still merge
    unit = np.repeat(np.arange(n_units), length)
    done_begin, done_unit, done_size = [], [], []
    end = np.append(begin[1:], base[-1])
    while len(begin):
        last = np.append(unit[1:] != unit[:-1], True)
        both = np.where(last, 0, np.append(end[1:], 0) - begin)          # size of a piece and its right neighbour
        ok = (both > 0) & (both <= longest)
        way = np.where(ok, cell[begin, np.where(ok, both - 1, 0)], -1)
        gain = score[np.where(way >= 0, way // 2, -1)]
        first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
        best = np.maximum.reduceat(gain, first)
        count = np.diff(np.append(first, len(begin)))
        merges = np.isfinite(best)
        over = np.repeat(~merges, count)
        done_begin.append(begin[over])
        done_unit.append(unit[over])
        done_size.append((end - begin)[over])
        hit = np.flatnonzero((gain == np.repeat(best, count)) & ~over)   # the leftmost of each unit's best
        hit = hit[np.append(True, unit[hit][1:] != unit[hit][:-1])] if len(hit) else hit
        end[hit] = end[hit + 1]
        keep = ~over
        keep[hit + 1] = False
        begin, end, unit = begin[keep], end[keep], unit[keep]
    begin, unit, size = np.concatenate(done_begin or [begin]), np.concatenate(done_unit or [unit]), np.concatenate(done_size or [begin])
    order = np.argsort(begin, kind="stable")
    begin, unit, size = begin[order], unit[order], size[order]
    return unit, cell[begin, size - 1], np.bincount(unit, minlength=n_units)


def edge_ids(unit: np.ndarray, what: np.ndarray, model: Model, n_units: int) -> tuple[np.ndarray, np.ndarray]:
    """(how many, ids) per unit of the pieces of ``merge_edges``: a character without a piece is its bytes' pieces, or unknown."""
    odd = what % 2 == 1
    ids, times = what // 2, np.ones(len(what), np.int64)
    if odd.any():
        points = np.unique(ids[odd])
        codes = {int(p): [model.bytes_from + x for x in chr(p).encode()] if model.bytes_from >= 0 else [model.unknown] for p in points}
        times[odd] = [len(codes[p]) for p in ids[odd].tolist()]
        flat = np.repeat(ids, times)
        flat[np.repeat(odd, times)] = [x for p in ids[odd].tolist() for x in codes[p]]
        ids = flat
    return np.bincount(unit, weights=times, minlength=n_units).astype(np.int64), ids


def merge_long(unit: str, model: Model, index: dict[str, int]) -> list[int]:
    """Ids of one long unit by the same merges, best first, leftmost of equals (linked list and heap)."""
    import heapq

    n = len(unit)
    nxt, prv, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive, heap = [True] * n, []

    def offer(i: int) -> None:
        j = nxt[i]
        if j < n and (p := index.get(unit[i:end[j]])) is not None:
            heapq.heappush(heap, (-model.scores[p], i, end[i], end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        j = nxt[i]
        if not alive[i] or end[i] != mid or j >= n or end[j] != stop:
            continue
        end[i], nxt[i], alive[j] = stop, nxt[j], False
        if nxt[j] < n:
            prv[nxt[j]] = i
        if prv[i] >= 0:
            offer(prv[i])
        offer(i)
    out: list[int] = []
    i = 0
    while i < n:
        p = index.get(unit[i:end[i]])
        out += [p] if p is not None else [model.bytes_from + b for b in unit[i:end[i]].encode()] if model.bytes_from >= 0 else [model.unknown]
        i = nxt[i]
    return out


def normalise(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def decode(ids, of: list[bytes]) -> str:
    """Text of the ids; bytes that aren't UTF-8 become the replacement character."""
    text = b"".join([of[i] for i in ids]).decode("utf-8", "replace").replace(MARK, " ")
    return text[1:] if text.startswith(" ") else text


def units_of(text: str) -> list[str]:
    """The units of a text in order, each without the mark that it begins with."""
    parts = text.replace(MARK, " ").split(" ") if text else []
    # a further blank is a mark of the unit after it
    return [u[1:] for u in UNIT.findall(normalise(text))] if "" in parts else parts


def _bytes_of(units: pa.StringArray) -> tuple[np.ndarray, bytes]:
    """Each unit's size in bytes, and the bytes of all."""
    off = np.frombuffer(units.buffers()[1], np.int32)[units.offset:units.offset + len(units) + 1]
    data = units.buffers()[2]
    return np.diff(off), data.slice(int(off[0]), int(off[-1] - off[0])).to_pybytes() if data is not None else b""


def _packed(units: pa.StringArray) -> bytes:
    sizes, raw = _bytes_of(units)
    return zstandard.compress(np.uint32(len(units)).tobytes() + ex.planes(sizes.astype(np.uint32)) + raw, 1)


def _unpacked(raw: bytes) -> pa.StringArray:
    raw = zstandard.decompress(raw)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    off = np.concatenate(([0], np.cumsum(ex.unplanes(raw[4:4 + 4 * n], np.uint32)))).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(off.tobytes()), pa.py_buffer(raw[4 + 4 * n:]))


def distinct_sorted(units: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The distinct units in order, and which of them each unit is."""
    coded = units.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), rank[coded.indices.to_numpy()]


def units_of_all(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """Units as by ``units_of`` of many texts: the distinct ones in order, which of them each unit of the texts is,
    one text after another, and where each text's begin (and the end)."""
    plain = pc.replace_substring(texts, MARK, " ") if pc.any(pc.match_substring(texts, MARK)).as_py() else texts
    parts = pc.split_pattern(plain, " ")
    off = parts.offsets.to_numpy().astype(np.int64)
    flat = parts.values.slice(off[0], off[-1] - off[0])
    off = off - off[0]
    blank = np.concatenate(([0], np.cumsum(pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False))))
    odd = np.flatnonzero(blank[off[1:]] > blank[off[:-1]]).tolist()      # empty, or with blanks in a row or at an end
    if odd:
        keep = np.ones(len(flat), bool)
        count, more = np.diff(off), []
        for i in odd:
            keep[off[i]:off[i + 1]] = False
            more.append(units_of(texts[i].as_py()))
            count[i] = len(more[-1])
        # the others' units, then those of the odd ones; ``place`` puts them in the order of the texts
        flat = pa.concat_arrays([flat.filter(pa.array(keep)), pa.array([u for own in more for u in own], pa.string())])
        is_odd = np.zeros(len(count), bool)
        is_odd[odd] = True
        place = np.argsort(np.repeat(is_odd, count), kind="stable")
        off = np.concatenate(([0], np.cumsum(count)))
    units, which = distinct_sorted(flat)
    if odd:
        which, moved = np.empty_like(which), which
        which[place] = moved
    return units, which, off


def _gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces of an array that begin at ``begin``, one after another."""
    if not len(begin):
        return flat[:0]
    before = np.concatenate(([0], np.cumsum(size)[:-1]))
    return flat[np.repeat(begin - before, size) + np.arange(int(size.sum()))]


def encode_documents(docs: DataFrame, model: Model, pieces: DataFrame, with_ids: bool = False, group_bytes: int = GROUP_BYTES,
                     bucket_units: int = BUCKET_UNITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_pieces``, ``ids_crc32`` (little-endian unsigned 32-bit ids),
    ``round_trip`` (decoding gives the text back, a mark in the text as a blank), and with
    ``with_ids`` the ``ids``.  Null text is empty and has no pieces."""
    plain = ex.text_groups(docs, None, group_bytes)
    buckets = max(1, plain.n * (group_bytes // 64) // bucket_units)
    limit, of, longest = MAX_UNIT if model.bpe else 1 << 30, model.bytes_of(), model.longest

    rows = ex.packed(plain.rows, level=6)

    def texts(table: pa.Table) -> tuple[pa.ChunkedArray, pa.StringArray]:
        own = ex.unpacked(table)
        return own.column("_id"), pa.concat_arrays(own.column("_text").chunks)

    def by_bucket(units: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The units' order by bucket, the buckets that have some, and where each one's begin (and the end)."""
        b = np.fromiter((xxhash.xxh3_64_intdigest(u) % buckets for u in units.to_pylist()), np.int64, len(units))
        order = np.argsort(b, kind="stable")
        own, first = np.unique(b[order], return_index=True)
        return order, own, np.append(first, len(units))

    def send(table: pa.Table) -> pa.Table:
        g = ex.group_id(table)
        units = units_of_all(texts(table)[1])[0]
        order, own, off = by_bucket(units)
        units = units.take(pa.array(order))
        parts = [_packed(units.slice(lo, hi - lo)) for lo, hi in zip(off[:-1].tolist(), off[1:].tolist())]
        return ex.table(UNITS, {"_g": [g] * len(parts), "b": own.tolist(), "units": parts})

    scores = np.array(model.scores)
    of_size = np.array([len(x) for x in of], np.int64)
    of_begin, of_flat = np.concatenate(([0], np.cumsum(of_size)[:-1])), np.frombuffer(b"".join(of), np.uint8)

    def short_units(raws: list[bytes]) -> tuple[pa.StringArray, np.ndarray, np.ndarray, pa.StringArray]:
        """A bucket's distinct short units in order; of all that were sent, which of them each is (-1: a long one), where
        each sender's begin (and the end), and the units themselves."""
        sent = [_unpacked(raw) for raw in raws]
        every = pa.concat_arrays(sent)
        units, which = distinct_sorted(every)
        short = pc.less(pc.utf8_length(units), limit).to_numpy(zero_copy_only=False)
        number = np.where(short, np.cumsum(short) - 1, -1)
        return units.filter(pa.array(short)), number[which], np.concatenate(([0], np.cumsum([len(x) for x in sent]))), every

    def distinct(table: pa.Table) -> pa.Table:
        b = table.column("b")[0].as_py()
        units = short_units(table.column("units").to_pylist())[0]
        marked = pc.binary_join_element_wise(MARK, units, "")
        return pa.table([pa.array(np.full(len(units), b, np.int32)), pa.array(np.arange(len(units), dtype=np.int32)), marked], names=["b", "u", "unit"])

    def coded_row(b: int, sizes: np.ndarray, ids: np.ndarray) -> dict:
        return {"b": [b], "sizes": [ex.dense(sizes.astype(np.uint32))], "ids": [ex.dense(ids.astype(np.uint32))]}

    def merge(batches):
        """One row per bucket; a partition has its buckets one after another, as ``distinct`` left them."""
        seen, b, parts = set(), None, []

        def row():
            u, edge = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            n = int(u.max()) + 1
            unit, what, _ = merge_edges(u, edge, scores, n, longest)
            return ex.table(FOLDED, coded_row(b, *edge_ids(unit, what, model, n))).to_batches()[0]

        for batch in batches:
            own = batch.column("b").to_numpy()
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if own[lo] != b:
                    if parts:
                        yield row()
                    b, parts = int(own[lo]), []
                    if b in seen:
                        raise RuntimeError(f"rows of bucket {b} are apart")
                    seen.add(b)
                parts.append((batch.column("u").to_numpy()[lo:hi].astype(np.int64), batch.column("edge").to_numpy()[lo:hi]))
        if parts:
            yield row()

    def pack(table: pa.Table) -> pa.Table:
        own = dict(zip(table.column("unit").to_pylist(), table.column("ids").to_pylist()))
        ids = [own[x] for x in sorted(own)]
        return ex.table(FOLDED, coded_row(table.column("b")[0].as_py(), np.array([len(i) for i in ids]), np.array([x for i in ids for x in i])))

    def reply(asked: pa.Table, coded: pa.Table) -> pa.Table:
        # the units of this bucket in the order of their numbers
        _, place, off, every = short_units(asked.column("units").to_pylist())
        size, ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        for own, raw in zip(coded.column("sizes").to_pylist(), coded.column("ids").to_pylist()):
            size, ids = ex.undense(own, np.uint32).astype(np.int64), ex.undense(raw, np.uint32)
        begin = np.concatenate(([0], np.cumsum(size)))
        # long units' ids come after those of the others
        long: dict[str, int] = {}
        more: list[np.ndarray] = []
        if (place < 0).any():
            index = {p: i for i, (p, ok) in enumerate(zip(model.pieces, model.normal)) if ok}
            for i in np.flatnonzero(place < 0).tolist():
                u = every[i].as_py()
                if u not in long:
                    long[u] = len(size) + len(more)
                    more.append(np.array(merge_long(MARK + u, model, index), np.uint32))
                place[i] = long[u]
            ids = np.concatenate([ids, *more])
            size = np.concatenate([size, [len(x) for x in more]])
            begin = np.concatenate(([0], np.cumsum(size)))
        out: dict[str, list] = {"_g": asked.column("_g").to_pylist(), "b": asked.column("b").to_pylist(), "sizes": [], "ids": []}
        for lo, hi in zip(off[:-1].tolist(), off[1:].tolist()):
            at = place[lo:hi]
            out["sizes"].append(ex.dense(size[at].astype(np.uint32)))
            out["ids"].append(ex.dense(_gather(ids, begin[at], size[at])))
        return ex.table(REPLY, out)

    out_schema = "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean" + (", ids array<int>" if with_ids else "")

    def assemble(table: pa.Table, side: pa.Table) -> pa.Table:
        ids, own = texts(table) if table.num_rows else (pa.array([], pa.int64()), pa.array([], pa.string()))
        units, which, off = units_of_all(own)
        order = by_bucket(units)[0]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        units, which = units.take(pa.array(order)), place[which]
        # replies by bucket hold the units in just this order
        replies = sorted(zip(*(side.column(c).to_pylist() for c in ("b", "sizes", "ids"))))
        size = np.concatenate([np.zeros(0, np.int64), *(ex.undense(s, np.uint32).astype(np.int64) for _, s, _ in replies)])
        held = np.concatenate([np.zeros(0, np.uint32), *(ex.undense(i, np.uint32) for _, _, i in replies)])
        begin = np.concatenate(([0], np.cumsum(size)))
        # texts come back if all units do; else each is decoded whole
        text_size, text_bytes = _bytes_of(pc.binary_join_element_wise(MARK, units, ""))
        coded_size = np.diff(np.concatenate(([0], np.cumsum(of_size[held])))[begin])
        plain = bool((coded_size == text_size).all()) and _gather(of_flat, of_begin[held], of_size[held]).tobytes() == text_bytes
        coded = _gather(held, begin[which], size[which]).astype("<u4")
        ends = np.concatenate(([0], np.cumsum(size[which])))[off]
        bounds = list(zip(ends[:-1].tolist(), ends[1:].tolist()))
        crc = [zlib.crc32(coded[a:z]) for a, z in bounds]
        same = [True] * len(own) if plain else [decode(coded[a:z].tolist(), of) == t.replace(MARK, " ") for (a, z), t in zip(bounds, own.to_pylist())]
        columns = [pa.array([None if i == int(ex.NO_ID) else i for i in ids.to_pylist()], pa.int64()), pa.array(np.diff(ends), pa.int64()),
                   pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
        names = ["doc_id", "n_pieces", "ids_crc32", "round_trip"]
        if with_ids:
            kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(coded.astype(np.int32)))
            columns, names = [*columns, kept], [*names, "ids"]
        return pa.table(columns, names=names)

    asked = rows.groupBy("_g").applyInArrow(send, UNITS)
    asked = asked.repartition(buckets, "b")              # one bucket to a partition, about: lattices are what costs
    words = asked.groupBy("b").applyInArrow(distinct, PLACED)
    if model.bpe:            # edges stay where their bucket is: neither they nor the units are shuffled
        coded = edge_rows(words, pieces, longest).mapInArrow(merge, FOLDED)
    else:
        coded = encode_units(words.select("b", "unit"), model, pieces).groupBy("b").applyInArrow(pack, FOLDED)
    replies = asked.groupBy("b").cogroup(coded.groupBy("b")).applyInArrow(reply, REPLY)
    return rows.groupBy("_g").cogroup(replies.groupBy("_g")).applyInArrow(assemble, out_schema)
