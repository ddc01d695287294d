"""Near-duplicate documents: exact n-gram Jaccard join with signature trees.

Two documents link when their sets of 5-word shingles have a Jaccard similarity of at least
0.8; the result is each document's component under links.

1. Exact copies: one representative per md5 of the text goes on.
2. Token statistics (``exchange``): in how many representatives each shingle occurs.  In the order
   (frequency, hash), linked sets must share a shingle among their first n - ceil(0.8 n) + 1;
   a document whose rarest shingles are its own ends here.  Passages that many otherwise
   different documents share come last in that order and seldom count.
3. Documents that share such a shingle, with sizes that could link, form families (connected
   components): every link lies inside one family.
4. Each family is joined by a signature tree: documents are leaves with a bitmap of hashed
   shingles; a node holds the OR of its leaves' bitmaps and their range of sizes.  A dual
   traversal drops node pairs whose largest possible overlap is too small; the leaf pairs
   that remain are decided on the whole sets, unless they are already connected.
   A family above ``block_docs`` documents is cut into chunks, and each pair of chunks is a task.
5. Components over the links found, then back to the copies.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reglink.llm import exchange as ex
from reglink.llm.components import components
from reglink.llm.stage import free_name, stage
from reglink.llm.words import mix, rolling, split, window_starts

WORD = r"[^\x20\x09-\x0D]"
SHINGLE = 5
PERCENT = 80
BLOCK_DOCS = 4096
BLOCK_TOKENS = 1 << 21
FAN = 8
BITS_A_TOKEN = 4
SLAB_WORDS = 1 << 21

SENT = "_g int, b int, k binary, n binary"
REPLY = "_g int, b int, reply binary"
# kind 0: prefix shingles (k), size classes (n) and ids; 1: local links between ids (k, n);
# 2: text tags (k), sizes (n) and ids; 3: a set
FOUND = "kind int, b int, id long, size int, k binary, n binary, ids binary"
EDGE = "a long, b long"


def shingle_sets(text, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text (sorted by text, hash), the text's number of each,
    and the sizes.  Fewer than n words: the whole sequence is the one shingle; none: empty."""
    w = split(text, lower=True)
    tokens, count = w.tokens, np.diff(w.off)
    h, ok = rolling(tokens, n), window_starts(w.off, n)
    hashes, docs = [h[ok]], [w.doc[:len(h)][ok]]
    for m in range(1, n):
        at = np.flatnonzero(count == m)
        if len(at):
            hashes.append(mix(rolling(tokens, m)[w.off[at]] ^ np.uint64(m)))
            docs.append(at)
    h, doc = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if len(h):
        new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
        h, doc = h[new], doc[new]
    return h, doc, np.bincount(doc, minlength=len(count)).astype(np.int64)


class Forest:
    """Union-find over 0..n-1 with whole label arrays."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: int, b: int) -> None:
        x, y = self.label[a], self.label[b]
        if x != y:
            self.label[self.label == max(x, y)] = min(x, y)


def forest_edges(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the given edges."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right = [], []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            left.append(x)
            right.append(y)
    return left, right


def _levels(sets: list[np.ndarray], width: int) -> list[tuple[np.ndarray, ...]]:
    """The signature tree, leaves first: per level OR-ed bitmaps (uint64 words), smallest and largest
    size, and the largest number of shingles that share a bit."""
    size = np.array([len(s) for s in sets], np.int64)
    bits = np.zeros((len(sets), width // 8), np.uint8)
    for i, s in enumerate(sets):
        at = (mix(s) >> np.uint64(17)) & np.uint64(width - 1)
        np.bitwise_or.at(bits[i], (at >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8)))
    maps = bits.view(np.uint64)
    extra = size - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
    levels = [(maps, size, size, extra)]
    while len(levels[-1][0]) > 1:
        maps, low, high, extra = levels[-1]
        at = np.arange(0, len(maps), FAN)
        levels.append((np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(low, at),
                       np.maximum.reduceat(high, at), np.maximum.reduceat(extra, at)))
    return levels


def _possible(left: tuple, right: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Mask of node pairs that may hold a link, and their largest possible overlap."""
    _, low_a, high_a, extra_a = left
    _, low_b, high_b, extra_b = right
    fits = (100 * high_a[i] >= percent * low_b[j]) & (100 * high_b[j] >= percent * low_a[i])
    most = np.zeros(len(i), np.int64)
    at = np.flatnonzero(fits)
    step = max(1, SLAB_WORDS // left[0].shape[1])
    for s in range(0, len(at), step):
        p = at[s:s + step]
        common = np.bitwise_count(left[0][i[p]] & right[0][j[p]]).sum(axis=1).astype(np.int64)
        most[p] = common + np.minimum(extra_a[i[p]], extra_b[j[p]])
    need = percent * (low_a[i] + low_b[j])               # (100 + percent) * overlap >= percent * (a + b)
    return fits & ((100 + percent) * most >= need), most


def tree_links(sets: list[np.ndarray], chunk: np.ndarray | None = None, percent: int = PERCENT) -> tuple[list[int], list[int]]:
    """Links (indices) that connect whatever the sets' links connect.  With ``chunk`` (0 or 1 per set)
    only pairs of different chunks are looked at."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), int(sets[i][0])))
    sides = [[i for i in order if chunk is None or chunk[i] == c] for c in (0, 1)]
    if chunk is None:
        sides[1] = sides[0]
    if not sides[0] or not sides[1]:
        return [], []
    width = 64
    while width < BITS_A_TOKEN * max(len(s) for s in sets):
        width *= 2
    left = _levels([sets[i] for i in sides[0]], width)
    right = left if chunk is None else _levels([sets[i] for i in sides[1]], width)
    depth = [len(left) - 1, len(right) - 1]
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    most = np.zeros(1, np.int64)
    while True:
        ok, most = _possible(left[depth[0]], right[depth[1]], i, j, percent)
        i, j, most = i[ok], j[ok], most[ok]
        if depth == [0, 0] or not len(i):
            break
        down = [depth[0] >= depth[1] and depth[0] > 0, depth[1] >= depth[0] and depth[1] > 0]
        for side, tree in ((0, left), (1, right)):
            if down[side]:
                n = len(tree[depth[side] - 1][0])
                here = i if side == 0 else j
                kids = here[:, None] * FAN + np.arange(FAN)
                row, col = np.nonzero(kids < n)
                kids = kids[row, col]
                i, j = (kids, j[row]) if side == 0 else (i[row], kids)
                depth[side] -= 1
        if chunk is None:
            half = i <= j
            i, j = i[half], j[half]
    if chunk is None:
        half = i < j
        i, j, most = i[half], j[half], most[half]
    a, b = np.array(sides[0])[i], np.array(sides[1])[j]
    rank = np.argsort(-most, kind="stable")
    a, b = a[rank], b[rank]
    forest, out = Forest(len(sets)), ([], [])
    while len(a):
        head = slice(0, 256)
        for x, y in zip(a[head].tolist(), b[head].tolist()):
            if forest.label[x] != forest.label[y]:
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                    forest.join(x, y)
                    out[0].append(x)
                    out[1].append(y)
        a, b = a[256:], b[256:]
        apart = forest.label[a] != forest.label[b]
        a, b = a[apart], b[apart]
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, block_docs: int = BLOCK_DOCS,
                    group_bytes: int = ex.GROUP_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_hash`` (md5), ``text_group`` (of the exchange),
    ``n_shingles`` and ``component_id``.

    Null or blank text has no shingles and links with nothing.  Rows with one ``doc_id`` are one
    node; a null ``doc_id`` counts as larger than all ids, and as null in the result where its
    component has no other id."""
    groups = ex.text_groups(docs, None, group_bytes)
    bits, rows = groups.bits, groups.rows
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(ex.NO_ID))).alias("_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    keyed = keyed.select("_id", F.md5(F.col("_text").cast("binary")).alias("md5"), ex.group_of(groups.n).alias("_g"), F.col("_text").rlike(WORD).alias("words"))
    members = stage(keyed, "members")
    reps = members.groupBy("md5").agg(F.min(F.struct("_id", "_g")).alias("r")).select("md5", "r._id", "r._g")
    reps = stage(reps, "representatives")

    def chosen(table: pa.Table, side: pa.Table):
        """The group's representatives: ids, shingles, text number of each shingle, sizes, texts."""
        want = np.array([i for i in side.column("id").to_pylist() if i is not None], np.int64)
        ids = table.column("_id").to_numpy()
        table = table.filter(pa.array(np.isin(ids, want)))
        h, doc, size = shingle_sets(table.column("_text"), shingle)
        return table.column("_id").to_numpy().astype(np.int64), h, doc, size, table.column("_text")

    def send(table: pa.Table, side: pa.Table) -> pa.Table:
        if not table.num_rows:
            return ex.table(SENT, {"_g": [], "b": [], "k": [], "n": []})
        g = ex.group_id(table)
        _, h, _, _, _ = chosen(table, side)
        keys, n = np.unique(h, return_counts=True)
        n = n.astype(np.uint32)
        edge = ex.bounds(keys, bits)
        used = np.flatnonzero(np.diff(edge))
        cut = [slice(edge[b], edge[b + 1]) for b in used]
        return ex.table(SENT, {"_g": [g] * len(used), "b": used.tolist(), "k": [ex.short(keys[c], bits, 4) for c in cut], "n": [ex.planes(n[c]) for c in cut]})

    def frequency(table: pa.Table) -> pa.Table:
        key, part = ex.pieces(table.column("k").to_pylist(), np.uint32)
        n, _ = ex.pieces(table.column("n").to_pylist(), np.uint32)
        _, where = np.unique(key, return_inverse=True)
        total = np.bincount(where, weights=n)
        code = np.minimum(255, np.ceil(8 * np.log2(total))).astype(np.uint8)[where]      # 0: a single document
        return ex.table(REPLY, {"_g": table.column("_g").to_pylist(), "b": table.column("b").to_pylist(),
                                "reply": [ex.planes(code[part[i]:part[i + 1]]) for i in range(table.num_rows)]})

    def size_class(size: np.ndarray) -> np.ndarray:
        """Sizes that could link lie in one class or in neighbouring ones."""
        return np.floor(np.log(np.maximum(size, 1)) / np.log(100 / percent) + 1e-9).astype(np.int64)

    def candidates(table: pa.Table, side: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in FOUND.split(", ")]
        out: dict[str, list] = {c: [] for c in names}

        def put(**row):
            for c in names:
                out[c].append(row.get(c))

        if not table.num_rows:
            return ex.table(FOUND, out)
        ids, h, doc, size, text = chosen(table, side)
        put(kind=2, k=b"".join(hashlib.md5(t.encode()).digest()[7::-1] for t in text.to_pylist()), n=size.tobytes(), ids=ids.tobytes())
        keys, where = np.unique(h, return_inverse=True)
        code = ex.answers(side, keys, bits, np.uint8)[where]
        order = np.lexsort((h, code, doc))
        start = np.cumsum(size) - size
        place = np.arange(len(h)) - start[doc[order]]
        reach = (size - -(-percent * size // 100) + 1)[doc[order]]
        at = order[(place < reach) & (code[order] > 0)]
        if len(at):
            kinds = size_class(size[doc[at]])
            key, owner = h[at], ids[doc[at]]
            by = np.lexsort((owner, kinds, key))
            key, kinds, owner = key[by], kinds[by], owner[by]
            new = np.r_[True, (key[1:] != key[:-1]) | (kinds[1:] != kinds[:-1])]
            head = owner[np.flatnonzero(new)[np.cumsum(new) - 1]]
            a, b = forest_edges(*(np.array(x, np.int64) for x in _distinct_pairs(head[~new], owner[~new])))
            if a:
                put(kind=1, k=ex.planes(np.array(a, np.int64)), n=ex.planes(np.array(b, np.int64)))
            key, kinds, owner = key[new], kinds[new], owner[new]
            edge = ex.bounds(key, bits)
            for b in np.flatnonzero(np.diff(edge)).tolist():
                c = slice(edge[b], edge[b + 1])
                put(kind=0, b=b, k=ex.planes(key[c]), n=ex.planes(kinds[c].astype(np.uint16)), ids=ex.planes(owner[c]))
            for d in np.unique(doc[at]).tolist():
                put(kind=3, id=int(ids[d]), size=int(size[d]), k=h[start[d]:start[d] + size[d]].tobytes())
        return ex.table(FOUND, out)

    def meet(table: pa.Table) -> pa.Table:
        key, _ = ex.pieces(table.column("k").to_pylist(), np.uint64)
        kinds, _ = ex.pieces(table.column("n").to_pylist(), np.uint16)
        owner, _ = ex.pieces(table.column("ids").to_pylist(), np.int64)
        order = np.lexsort((owner, kinds, key))
        key, kinds, owner = key[order], kinds[order].astype(np.int64), owner[order]
        near = (key[1:] == key[:-1]) & (kinds[1:] - kinds[:-1] <= 1)
        a, b = forest_edges(*_distinct_pairs(owner[:-1][near], owner[1:][near]))
        return ex.table(EDGE, {"a": a, "b": b})

    def unpack(batches):
        for batch in batches:
            for k, n in zip(batch.column("k").to_pylist(), batch.column("n").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(ex.unplanes(k, np.int64)), pa.array(ex.unplanes(n, np.int64))], names=["a", "b"])

    def unpack_sizes(batches):
        for batch in batches:
            for columns in zip(*(batch.column(c).to_pylist() for c in ("ids", "k", "n"))):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(c, np.int64)) for c in columns], names=["s_id", "s_tag", "n"])

    def join_family(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        left, right = [], []
        roots = table.column("root").to_numpy()
        for root in np.unique(roots).tolist():
            part = table.filter(pa.array(roots == root))
            ids = part.column("id").to_pylist()
            sets, first, same = [], {}, []
            chunk = []
            pair = part.column("pair")[0].as_py()
            for x, (raw, side) in enumerate(zip(part.column("k").to_pylist(), part.column("side").to_pylist())):
                key = (raw, side if pair else 0)
                if key in first:            # equal sets link without a look
                    left.append(ids[first[key][0]])
                    right.append(ids[x])
                    continue
                first[key] = (x, len(sets))
                sets.append(np.frombuffer(raw, np.uint64))
                chunk.append(side)
                same.append(x)
            a, b = tree_links(sets, np.array(chunk) if pair else None, percent)
            left += [ids[same[x]] for x in a]
            right += [ids[same[x]] for x in b]
        return ex.table(EDGE, {"a": left, "b": right})

    marks = reps.select("_g", F.lit(-1).alias("b"), F.lit(None).cast("binary").alias("reply"), F.col("_id").alias("id"))
    sent = rows.groupBy("_g").cogroup(marks.groupBy("_g")).applyInArrow(send, SENT)
    replies = sent.groupBy("b").applyInArrow(frequency, REPLY).select("_g", "b", "reply", F.lit(None).cast("long").alias("id"))
    found = stage(rows.groupBy("_g").cogroup(replies.unionAll(marks).groupBy("_g")).applyInArrow(candidates, FOUND), "candidates")

    meeting = found.where("kind = 0").select("b", "k", "n", "ids").groupBy("b").applyInArrow(meet, EDGE)
    local = found.where("kind = 1").select("k", "n").mapInArrow(unpack, EDGE)
    families = components(meeting.unionAll(local))
    sizes = families.groupBy("root").agg(F.count(F.lit(1)).alias("docs"))
    sized = families.join(sizes, "root")
    chunks = F.ceil(F.col("docs") / F.lit(block_docs)).cast("int")
    mine = F.when(chunks > 1, F.pmod(F.xxhash64("node"), chunks)).otherwise(F.lit(0)).cast("int")
    sized = sized.select("node", "root", chunks.alias("chunks"), mine.alias("chunk"))
    sets = found.where("kind = 3").select("id", "size", "k")
    total = sets.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    tasks = max(1, -(-total // BLOCK_TOKENS))
    each = sets.join(sized, sets.id == sized.node).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    task = F.when(F.col("chunks") == 1, F.array(F.pmod(F.xxhash64("root"), F.lit(tasks)), F.lit(-1).cast("long"), F.lit(-1).cast("long"))).otherwise(
        F.array(F.col("root"), F.least("chunk", "other").cast("long"), F.greatest("chunk", "other").cast("long")))
    each = each.select(task.alias("task"), "root", "id", "k", (F.col("chunk") > F.col("other")).cast("int").alias("side"),
                       ((F.col("chunks") > 1) & (F.col("chunk") != F.col("other")) & F.lit(True)).alias("pair"))
    links = each.groupBy("task").applyInArrow(join_family, EDGE)
    # an id with several texts is one node: its texts' representatives are linked through it
    several = members.where("words").groupBy("_id").agg(F.min("md5").alias("x"), F.max("md5").alias("y")).where("x <> y").select(F.col("_id").alias("a"))
    through = (members.where("words").join(several, F.col("_id") == F.col("a")).select("a", F.col("md5").alias("m"))
               .join(reps, F.col("m") == reps.md5).select("a", reps["_id"].alias("b")))
    linked = components(links.unionAll(through))

    counted = found.where("kind = 2").select("ids", "k", "n").mapInArrow(unpack_sizes, "s_id long, s_tag long, n long")
    return _labelled(members, reps, counted, linked)


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(a):
        return a, b
    both = np.unique(np.stack([a, b], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def _labelled(members: DataFrame, reps: DataFrame, counted: DataFrame, linked: DataFrame) -> DataFrame:
    """Sizes and components of the representatives, handed to their copies."""
    sizes = counted.groupBy("s_id", "s_tag").agg(F.max("n").alias("n_shingles"))
    tag = F.conv(F.substring(reps["md5"], 1, 16), 16, -10).cast("long")
    root = reps.join(sizes, (reps["_id"] == F.col("s_id")) & (tag == F.col("s_tag")), "left").join(linked, reps["_id"] == F.col("node"), "left")
    root = root.select(reps["md5"].alias("r_md5"), "n_shingles", F.coalesce("root", "_id").alias("component"))
    out = members.join(root, members.md5 == F.col("r_md5"))
    empty = F.col("n_shingles") == 0
    component = F.when(empty, F.col("_id")).otherwise(F.col("component"))
    none = F.lit(int(ex.NO_ID))
    return out.select(F.nullif("_id", none).alias("doc_id"), F.col("md5").alias("text_hash"), members["_g"].alias("text_group"),
                      F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), F.nullif(component, none).alias("component_id"))


def keep_first(docs: DataFrame, found: DataFrame, group_bytes: int = ex.GROUP_BYTES) -> DataFrame:
    """Rows of ``docs`` that head their component in ``near_duplicates``' result: one row each, the one of
    the smallest id (of texts with that id, the one of the smallest hash; of equal rows, one).
    Rows without shingles link with nothing and all stay.  Columns unchanged."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    mark = free_name("_null_text", docs.columns)
    marked = docs.withColumn(mark, F.col("text").isNull())
    rows = ex.text_groups(marked, [*others, mark], group_bytes).rows
    held = {c: f"_c{i}" for i, c in enumerate([*others, mark])}
    none = F.lit(int(ex.NO_ID))
    heads = found.where((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    heads = (heads.groupBy(F.coalesce("doc_id", none).alias("id")).agg(F.min(F.struct("text_hash", "text_group")).alias("h"))
             .select(F.col("h.text_group").alias("_g"), "id", F.col("h.text_hash").alias("text_hash")))
    schema = docs.schema

    def choose(table: pa.Table, side: pa.Table) -> pa.Table:
        want = dict(zip(side.column("id").to_pylist(), side.column("text_hash").to_pylist()))
        keep = []
        for i, text in zip(table.column("_id").to_pylist(), table.column("_text").to_pylist()):
            raw = text.encode()
            if not raw.split():
                keep.append(True)
            else:
                hit = want.get(i) == hashlib.md5(raw).hexdigest()
                keep.append(hit)
                if hit:
                    del want[i]
        kept = table.filter(pa.array(keep, pa.bool_()))
        null = kept.column(held[mark]).combine_chunks()
        ids = kept.column("_id").to_numpy()
        own = {"doc_id": pa.array(ids, pa.int64(), mask=ids == ex.NO_ID), "text": pc.if_else(null, pa.scalar(None, pa.string()), kept.column("_text").combine_chunks().cast(pa.string()))}
        return pa.table([own[c] if c in own else kept.column(held[c]) for c in names], names=names)

    names = docs.columns
    wide = T.StructType([T.StructField(f.name, T.LongType() if f.name == "doc_id" else T.StringType() if f.name == "text" else f.dataType) for f in schema])
    out = rows.groupBy("_g").cogroup(heads.groupBy("_g")).applyInArrow(choose, wide)
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
