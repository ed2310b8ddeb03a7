"""Exact Jaccard join of word shingles with a token-group matrix.

Documents with equal sets are one. All tokens have a fixed order, frequent ones last; documents that link share a token
among the first |x| - ceil(t |x|) + 1 of either. A document's group is named by the least hash of its tokens; similar
documents mostly agree in it. Shared tokens tell which documents have to visit which groups, always the group with the
smaller name.

Within a group, documents gather around leaders that they link with. The token-group matrix holds the union of tokens
of each gathering; how many tokens a document shares with the union bounds its overlap with every member, and only
gatherings whose bound allows a link, and which aren't connected with it already, are opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriflux.llm import blocks as B
from veriflux.llm import words as W
from veriflux.llm.components import components, look_up
from veriflux.llm.store import stored

WIDTH = 5
SHARED, ALL = 75, 100  # two documents link when ALL * intersection >= SHARED * union
HOT_TOKENS = 1 << 18  # frequent tokens that are moved to the end of the order; any choice gives the same links
HOT_IN_BATCH = 3
PART_ROWS = 8192  # documents of a group that one task holds; larger groups are cut into parts
SMALL = 32
BROADCAST_ROWS = 100_000
SUMMARY = "nul boolean, id bigint, node bigint, n bigint, s1 bigint, s2 bigint, g bigint, token bigint, times bigint"
SHIPPED = "g bigint, part int, home boolean, nul boolean, id bigint, node bigint, body binary"
KEY = ["nul", "id", "node"]  # of a document; the order of keys decides which document a component is named by
LINKS = ", ".join(f"{end} struct<nul:boolean,id:bigint,node:bigint>" for end in "ab")
NAME_SHIFT = np.uint64(24)


def _sets(column, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk: number of its first document, distinct shingle hashes of all its documents, offsets."""
    for c in W.chunks(column, lower=True):
        n = np.diff(c.doc)
        words = c.hashes()
        owner, place = c.owners()
        at = np.flatnonzero(place + width <= n[owner]) if len(owner) else owner
        hashes, doc = [W.window_hashes(words, at, width)], [owner[at]]
        for size in range(1, width):  # shorter documents: the whole sequence
            short = np.flatnonzero(n == size)
            hashes.append(W.window_hashes(words, c.doc[short], size))
            doc.append(short)
        hashes, doc = np.concatenate(hashes), np.concatenate(doc)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
        yield c.first, hashes[new], np.searchsorted(doc[new], np.arange(len(n) + 1))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.uint64))).astype(np.uint64)
    return total[offsets[1:]] - total[offsets[:-1]]


def _summaries(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Per document: size and 128-bit signature of its set. Per batch: tokens that several different sets hold."""
    names = [x.split()[0] for x in SUMMARY.split(", ")]
    for batch in batches:
        seen, tokens = set(), []
        for first, hashes, offsets in _sets(batch.column("text"), width):
            n = len(offsets) - 1
            s1, s2 = (_sums(W.mix(hashes ^ np.uint64(k)), offsets).view(np.int64) for k in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
            rows = batch.slice(first, n)
            size = np.diff(offsets)
            name = np.zeros(n, np.int64)
            name[size > 0] = hashes[offsets[:-1][size > 0]] >> NAME_SHIFT
            yield pa.RecordBatch.from_arrays(
                [rows.column(k) for k in ("nul", "id", "node")] + [pa.array(x, pa.int64()) for x in (size, s1, s2, name)] + [pa.nulls(n, pa.int64())] * 2, names,
            )
            for k, key in enumerate(zip(s1.tolist(), s2.tolist(), strict=True)):
                if key not in seen:
                    seen.add(key)
                    tokens.append(hashes[offsets[k] : offsets[k + 1]])
        all_ = np.sort(np.concatenate(tokens)) if tokens else np.zeros(0, np.uint64)
        edge = W.runs(all_)
        times = np.diff(edge)
        often = times >= HOT_IN_BATCH
        n = int(often.sum())
        columns = [pa.nulls(n, pa.bool_())] + [pa.nulls(n, pa.int64())] * 6 + [pa.array(all_[edge[:-1][often]].view(np.int64)), pa.array(times[often])]
        yield pa.RecordBatch.from_arrays(columns, names)
    W.give_back()


def _ordered(hashes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Place of tokens in the order: by hash, frequent ones last."""
    place = hashes >> np.uint64(1)
    if len(hot):
        place |= (hot[np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)] == hashes).astype(np.uint64) << np.uint64(63)
    return place


_ENTRY = (np.uint64, np.uint64, np.uint32, np.uint32)  # token, group, document, size
_MEMBER = (np.uint64, np.uint32, np.uint32)  # group, document, size
MEMBERS = 2  # kind of message
# document, group, part (-1: visits, -2: at home), first part to visit, shared tokens, least and largest partner
_VISIT = (np.uint32, np.uint64, np.int32, np.int32, np.uint32, np.uint32, np.uint32)


def _kept_rows(table: pa.Table, nodes: pa.Table) -> dict[int, int]:
    """Numbers of the documents that stand for their set, each with its node."""
    wanted, out = set(nodes.column("node").to_pylist()), {}
    for k, node in enumerate(table.column("node").to_pylist()):
        if node in wanted:
            wanted.discard(node)
            out[k] = node
    return out


def _prefixes(table: pa.Table, nodes: pa.Table, width: int, hot: np.ndarray, buckets: int) -> pa.Table:
    out = B.Outbox()
    if not table.num_rows or not nodes.num_rows:
        return out.table()
    table, block = B.in_order(table), B.block_of(table)
    kept = np.zeros(table.num_rows, bool)
    kept[list(_kept_rows(table, nodes))] = True
    got, members = [], []
    for first, hashes, offsets in _sets(table.column("text"), width):
        n = np.diff(offsets)
        doc = np.repeat(np.arange(len(n)), n)
        place = _ordered(hashes, hot)
        order = np.lexsort((place, doc))
        place = place[order]
        nth = np.arange(len(doc)) - offsets[doc]
        length = n - -(-SHARED * n // ALL) + 1
        take = np.flatnonzero(kept[doc + first] & (nth < length[doc]))
        mine = np.flatnonzero(kept[first : first + len(n)] & (n > 0))
        name = np.zeros(len(n), np.uint64)
        name[mine] = hashes[offsets[mine]] >> NAME_SHIFT  # the least hash, frequent or not: copies mostly share it
        got.append((place[take], name[doc[take]], doc[take] + first, n[doc[take]]))
        members.append((name[mine], mine + first, n[mine]))
    name, doc, size = (np.concatenate(x) for x in zip(*members, strict=True))
    order = np.argsort(W.mix(name), kind="stable")
    out.spread(buckets, block, MEMBERS, W.mix(name[order]), *(p[order].astype(t) for p, t in zip((name, doc, size), _MEMBER, strict=True)))
    place, name, doc, size = (np.concatenate(x) for x in zip(*got, strict=True))
    token = W.mix(place)  # first tokens have low places: mixed, they spread over all buckets
    order = np.argsort(token, kind="stable")
    token = token[order]
    parts = (token >> np.uint64(16), name[order], doc[order], size[order])
    out.spread(buckets, block, B.ENTRY, token, *(p.astype(t) for p, t in zip(parts, _ENTRY, strict=True)))
    return out.table()


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ALL * np.minimum(a, b) >= SHARED * np.maximum(a, b)


def _visits(table: pa.Table) -> pa.Table:
    """Tells blocks which of their documents go to which groups."""
    block, token, name, idx, size = B.gathered(table, B.ENTRY, _ENTRY)
    order = np.argsort(token, kind="stable")
    edge = W.runs(token[order])
    n = np.repeat(np.diff(edge), np.diff(edge))
    order = order[n > 1]
    block, token, name, idx, size = (x[order] for x in (block, token, name, idx, size))
    size = size.astype(np.int64)
    order = np.lexsort((size, name, token))
    block, token, name, idx, size = (x[order] for x in (block, token, name, idx, size))
    edge = W.runs(token)
    length = np.diff(edge)
    found: list[tuple[np.ndarray, ...]] = []

    def add(rows: np.ndarray, *values) -> None:
        """Rows with group, part, first part, least and largest partner."""
        found.append((rows, *(np.broadcast_to(v, rows.shape) for v in values)))

    # Few documents with a token: all pairs of it side by side, by the distance between them.
    start = np.repeat(edge[:-1], length)
    few = np.repeat(length <= SMALL, length)
    for gap in range(1, SMALL):
        y = np.arange(len(token) - gap) if len(token) > gap else np.zeros(0, np.int64)
        q = y + gap
        both = (start[y] == start[q]) & few[y] & _close(size[y], size[q])
        y, q = y[both], q[both]
        if not len(y):
            continue
        home = name[y] == name[q]
        add(y, name[y], -2, 0, size[q], size[q])
        add(q[home], name[q[home]], -2, 0, size[y[home]], size[y[home]])
        add(q[~home], name[y[~home]], -1, 0, size[y[~home]], size[y[~home]])
    # Many: by group and document.
    for s, e in zip(edge[:-1][length > SMALL].tolist(), edge[1:][length > SMALL].tolist(), strict=True):
        names, first = np.unique(name[s:e], return_index=True)
        last = np.append(first[1:], e - s) - 1
        least, most = size[s:e][first], size[s:e][last]
        for k, (f, l) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
            rows = np.arange(s + f, s + l + 1)
            after = np.arange(s + l + 1, e)
            far = (ALL * size[after] < SHARED * least[k]) | (ALL * most[k] < SHARED * size[after])
            after = after[~far]
            if len(after):
                add(after, names[k], -1, 0, least[k], most[k])
            if len(rows) > 1 or len(after):
                add(rows, name[rows], -2, 0, least.min(), most.max())
    # Groups that one task can't hold are cut by size; parts visit the earlier ones that sizes allow.
    n_entries = len(token)
    its_block, its_name, its_idx, its_size = B.gathered(table, MEMBERS, _MEMBER)
    its_size = its_size.astype(np.int64)
    order = np.lexsort((its_idx, its_block, its_size, its_name))
    edge = W.runs(its_name[order])
    block, idx = np.concatenate((block, its_block)), np.concatenate((idx, its_idx))
    for s, e in zip(edge[:-1], edge[1:], strict=True):
        if e - s > PART_ROWS:
            rows, sizes = order[s:e], its_size[order[s:e]]
            lows = np.searchsorted(sizes, -(-SHARED * sizes // ALL)) // PART_ROWS
            add(rows + n_entries, its_name[rows], np.arange(len(rows)) // PART_ROWS, lows, 1, 1 << 31)
    out = B.Outbox()
    if found:
        rows, groups, parts, lows, least, most = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((parts, groups, idx[rows], block[rows]))
        rows, groups, parts, lows, least, most = (x[order] for x in (rows, groups, parts, lows, least, most))
        new = np.ones(len(rows), bool)
        new[1:] = (block[rows][1:] != block[rows][:-1]) | (idx[rows][1:] != idx[rows][:-1]) | (groups[1:] != groups[:-1]) | (parts[1:] != parts[:-1])
        head = np.flatnonzero(new)
        shared, least, most = np.diff(np.append(head, len(rows))), np.minimum.reduceat(least, head), np.maximum.reduceat(most, head)
        rows, groups, parts, lows = rows[head], groups[head], parts[head], lows[head]
        cut = W.runs(block[rows])
        values = [v.astype(t) for v, t in zip((idx[rows], groups, parts, lows, shared, least, most), _VISIT, strict=True)]
        for s, e in zip(cut[:-1], cut[1:], strict=True):
            out.add(0, block[rows[s]], B.OWN, *(v[s:e] for v in values))
    return out.table()


def _least_shared(n: int, least: int, most: int) -> int:
    """Tokens that a document of n tokens shares with a partner of least to most tokens within the first ones of both, if
    they link. Beyond the prefix that ends first, they share at most what is left of that document: less than its
    required overlap. What is missing to the link is least for the smallest or the largest partner."""
    need = []
    for s in (least, most):
        s = min(max(s, SHARED * n // ALL), -(-ALL * n // SHARED))
        need.append(SHARED * (n + s) / (ALL + SHARED) - SHARED * max(n, s) / ALL)
    return int(min(need)) - 1


def _shipments(table: pa.Table, replies: pa.Table, width: int) -> pa.Table:
    """The sets of documents, for each group that they belong to or visit."""
    rows: list[tuple] = []
    if table.num_rows and replies.num_rows:
        table = B.in_order(table)
        keys = list(zip(*(table.column(name).to_pylist() for name in KEY), strict=True))
        visits: dict[int, dict[int, list[int]]] = {}
        for k, g, p, l, shared, least, most in zip(*(x.tolist() for x in B.gathered(replies, B.OWN, _VISIT)[1:]), strict=True):
            held = visits.setdefault(k, {}).setdefault(g, [p, l, 0, least, most])
            if p > held[0]:
                held[:2] = p, l
            held[2] += shared
            held[3], held[4] = min(held[3], least), max(held[4], most)
        # -2: at home, in the first part unless the part is told; -1: visits. A document never visits its own group.
        for first, hashes, offsets in _sets(table.column("text"), width):
            for k in range(first, first + len(offsets) - 1):
                mine = hashes[offsets[k - first] : offsets[k - first + 1]]
                for g, (p, l, shared, least, most) in visits.get(k, {}).items():
                    if p < 0 and shared < _least_shared(len(mine), least, most):
                        continue
                    body = B.pack(mine)
                    if p == -1:
                        rows.append((g, -1, False, *keys[k], body))
                        continue
                    rows.append((g, max(p, 0), True, *keys[k], body))
                    rows += [(g, other, False, *keys[k], body) for other in range(l, max(p, 0))]
    types = (pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in SHIPPED.split(", ")])


class _Forest:
    """Which documents are known to be connected."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def group_links(sets: list[np.ndarray], n_home: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among the first n_home sets, and between these and the others.

    Overlap o of sets of sizes a and b is a link when (ALL + SHARED) o >= SHARED (a + b)."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    begin = np.concatenate(([0], np.cumsum(size)))
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(token[: begin[n_home]], minlength=int(token.max()) + 1)
    of = [token[begin[k] : begin[k + 1]] for k in range(n)]
    mark = np.zeros(len(often), bool)
    forest, links = _Forest(n), []

    def linked(k: int, others: np.ndarray) -> np.ndarray:
        """Which of the others, given by number, document k links with; its tokens are marked."""
        flat = np.concatenate([of[j] for j in others])
        cut = np.concatenate(([0], np.cumsum(size[others])[:-1]))
        shared = np.add.reduceat(mark[flat].astype(np.int64), cut)
        return (ALL + SHARED) * shared >= SHARED * (size[k] + size[others])

    def connect(a: int, b: int) -> None:
        if forest.join(a, b):
            links.append((a, b))

    # Gatherings: the documents whose tokens are most frequent here become leaders first.
    central = np.array([often[of[k]].mean() for k in range(n_home)])
    leaders: list[int] = []
    gathered = np.zeros(n_home, np.int64)
    for k in np.argsort(-central, kind="stable").tolist():
        fits = np.array([g for g, j in enumerate(leaders) if _close(size[k], size[j])], np.int64)
        if len(fits):
            mark[of[k]] = True
            hit = fits[linked(k, np.array(leaders)[fits])]
            mark[of[k]] = False
        else:
            hit = fits
        for g in hit.tolist():
            connect(k, leaders[g])
        gathered[k] = hit[0] if len(hit) else len(leaders)
        if not len(hit):
            leaders.append(k)
    # The matrix: for each token, the gatherings whose union holds it.
    doc = np.repeat(np.arange(n_home), size[:n_home])
    pair = np.unique(token[: begin[n_home]].astype(np.int64) * len(leaders) + gathered[doc])
    row = np.searchsorted(pair // len(leaders), np.arange(len(often) + 1))
    column = pair % len(leaders)
    members = [np.flatnonzero(gathered == g) for g in range(len(leaders))]
    least, most = (np.array([f(size[m]) for m in members]) for f in (np.min, np.max))
    for k in range(n):
        low, high = row[of[k]], row[of[k] + 1]
        spread = np.repeat(low - np.cumsum(high - low) + (high - low), high - low) + np.arange((high - low).sum())
        bound = np.bincount(column[spread], minlength=len(leaders))
        smallest = np.maximum(least, -(-SHARED * size[k] // ALL))
        open_ = ((ALL + SHARED) * bound >= SHARED * (size[k] + smallest)) & (ALL * size[k] >= SHARED * least) & (ALL * most >= SHARED * size[k])
        mine = forest.root(k)
        for g in np.flatnonzero(open_).tolist():
            if forest.root(leaders[g]) == mine:
                continue
            mark[of[k]] = True
            hit = linked(k, members[g])
            mark[of[k]] = False
            if hit.any():
                connect(k, int(members[g][hit.argmax()]))
                mine = forest.root(k)
    return links


def _group(table: pa.Table) -> pa.Table:
    table = table.sort_by([("home", "descending"), *((name, "ascending") for name in KEY)]).combine_chunks()
    home = int(np.sum(table.column("home").to_numpy(zero_copy_only=False)))
    links: list[tuple[int, int]] = []
    if home and table.num_rows > 1:
        links = group_links([B.unpack(body, (np.uint64,))[0] for body in table.column("body").to_pylist()], home)
    ends = [table.select(KEY).take(pa.array([link[end] for link in links], pa.int64())).combine_chunks() for end in (0, 1)]
    ends = [pa.StructArray.from_arrays([pa.array(t.column(name).to_pylist(), t.schema.field(name).type) for name in KEY], KEY) for t in ends]
    return pa.table(ends, names=["a", "b"])


def _identity(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """Whether the id is null, the id or a hash in its place, and a number for the row from id and text."""
    text, own = docs[text_col].cast("string"), docs[id_col].cast("long")
    nul, id_ = own.isNull(), F.coalesce(own, F.xxhash64(text))
    return nul, id_, F.xxhash64(nul, id_, text)


def _memberships(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """For each row of `docs` nul, id, node, n (size of its set) and c, the least member (nul, id, node) of its component;
    c is null if the set is empty."""
    spark = docs.sparkSession
    buckets = B.partitions(docs)
    nul, id_, node = _identity(docs, id_col, text_col)
    rows = docs.select(nul.alias("nul"), id_.alias("id"), node.alias("node"), docs[text_col].cast("string").alias("text"))
    summary = stored(rows.mapInArrow(lambda b: _summaries(b, width), SUMMARY), "near-copies")
    often = summary.filter("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    often = often.orderBy(F.desc("times"), "token").limit(HOT_TOKENS).select("token").toArrow()
    hot = spark.sparkContext.broadcast(np.sort(often.column("token").to_numpy().view(np.uint64)))
    sizes = summary.filter("token is null").drop("token", "times")
    stands = sizes.filter("n > 0").groupBy("n", "s1", "s2").agg(F.first("g").alias("g"), F.min(F.struct(*KEY)).alias("rep"), F.count("*").alias("times"))
    stands = stored(stands, "near-copies")
    blocks = 2 * buckets
    texts = B.blocked(docs, id_col, text_col, blocks, node=node)
    block = F.pmod(F.xxhash64("rep.nul", "rep.id"), F.lit(blocks)).cast("int").alias("block")
    nodes = B.to_blocks(stands.select(block, "rep.node"))
    sent = texts.groupBy("block").cogroup(nodes.groupBy("block"))
    sent = sent.applyInArrow(lambda t, r: _prefixes(t, r, width, hot.value, buckets), B.MESSAGE)
    replies = B.to_buckets(sent).groupBy("bucket").applyInArrow(_visits, B.MESSAGE)
    together = texts.groupBy("block").cogroup(B.to_blocks(replies).groupBy("block"))
    shipped = together.applyInArrow(lambda t, r: _shipments(t, r, width), SHIPPED)
    shipped = _to_all_parts(shipped, stands.groupBy("g").agg(F.count("*").alias("rows")).filter(F.col("rows") > PART_ROWS))
    links = shipped.groupBy("g", "part").applyInArrow(_group, LINKS)
    roots = components(links)
    by_set = stands.join(roots, F.col("rep") == F.col("node"), "left").select("n", "s1", "s2", "times", F.coalesce("root", "rep").alias("c"))
    sizes = sizes.select(*KEY, "n", "s1", "s2")
    return look_up(sizes, stored(by_set, "near-copies"), ["n", "s1", "s2"], sizes.count()).select(*KEY, "n", "c")


def link_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of `docs`.

    A document's set: the distinct shingles of `width` lower-case words; with fewer words, the whole sequence as one.
    Two documents link when 100 * intersection >= 75 * union; component_id is the least id that links lead to.
    Null and empty texts have an empty set and link with nothing: their component is their own id. Rows that share an id
    are documents of their own, full copies of a row one; a null id counts as larger than all others, and a component
    without any id has none. An empty table gives no rows. Other columns are not read.

    Every link is found; the order of tokens only decides what that costs. The texts are scanned once, shuffled once and
    read twice after that; sets travel once to their group and once to each group that they have to visit.
    """
    found = _memberships(docs, id_col, text_col, width)
    alone = F.when(~F.col("nul"), F.col("id"))
    component = F.when(F.col("c").isNull(), alone).when(~F.col("c.nul"), F.col("c.id"))
    return found.select(alone.alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows of `docs`, all columns as they are: of each component the document with the least id, and every document
    with an empty set. Of full copies (equal id and text) one row stays."""
    found = stored(_memberships(docs, id_col, text_col, width), "near-copies")
    gone = found.filter(F.col("c") != F.struct(*KEY)).select(F.struct(*KEY).alias("gone")).distinct()
    copied = found.filter("c is not null").groupBy(*KEY).agg(F.count("*").alias("times")).filter("times > 1").select(F.struct(*KEY).alias("copied"))
    key = F.struct(*(c.alias(name) for c, name in zip(_identity(docs, id_col, text_col), KEY, strict=True)))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key"))
    rows = rows.join(gone, F.col("key") == F.col("gone"), "left_anti")
    if not copied.isEmpty():
        single = rows.join(copied, F.col("key") == F.col("copied"), "left_anti")
        rows = single.unionByName(rows.join(copied, F.col("key") == F.col("copied"), "left_semi").dropDuplicates(["key"]))
    return rows.select("row.*")


def _to_all_parts(shipped: DataFrame, large: DataFrame) -> DataFrame:
    """Visitors go to every part of a group that was cut. large: g, rows of these groups, of which few exist."""
    last = F.lit(0)
    if n := large.count():
        cut = large.select(F.col("g").alias("cut"), ((F.col("rows") - 1) / PART_ROWS).cast("int").alias("last"))
        shipped = shipped.join(F.broadcast(cut) if n <= BROADCAST_ROWS else cut, F.col("g") == F.col("cut"), "left")
        last = F.coalesce("last", F.lit(0))
    parts = F.when(F.col("part") < 0, F.sequence(F.lit(0), last)).otherwise(F.array("part"))
    return shipped.select("g", F.explode(parts).alias("part"), "home", *KEY, "body")
