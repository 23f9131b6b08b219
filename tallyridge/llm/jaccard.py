"""Similarity join of word-shingle sets by token groups.

Equal sets are one node. Similar nodes are partitioned into groups such that no link leaves a group: the tokens of a
set are dealt into more parts than two linked sets can differ in, so linked sets agree in a whole part. Nodes that
share a part and whose sketches (parities of token counts, a bound on how much the sets differ) allow a link are grouped
(connected components). Inside a group, blocks of members keep the union of their tokens as the
columns of a token-group matrix; a set whose overlap with a block's union cannot reach the required share does not open
the block, and the opened ones are compared exactly by products of the matrix.

A group or block never holds all copies of a text (they are one node); parts and groups with many nodes are cut into
blocks, and pairs of blocks are compared by different tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyridge.llm.components import components
from tallyridge.llm.tables import ODD, WordHashes, byte_slices, mixed, phrase_hashes, raw_texts, staged

SKETCHED = np.uint64(0x9FB21C651E98DF25)
GROWTH = 1.5  # sizes up to this ratio are dealt into equally many parts
BLOCK_MEMBERS, BLOCK_TOKENS, COLUMNS = 512, 1 << 18, 4096
MEETING_ROWS = 4096
NODE_SCHEMA = "doc_id long, n_shingles long, node long, check long, sketch binary"
MEETING_SCHEMA = "node long, parts array<long>"


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; fewer words than ``size`` are one shingle, no words none."""
    return np.unique(phrase_hashes(hashes, min(size, len(hashes)))) if len(hashes) else np.empty(0, np.uint64)


class Dealer:
    """Parts of a set for a similarity of ``num / den``. Linked sets a <= b differ in at most ``a * (den - num) // num`` tokens."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        first = max(1, -(-num // max(1, den - num)))  # smaller sets can only be linked if equal
        self.edges = [first]

    def classes(self, size: int) -> list[int]:
        """Size classes whose parts the set takes: its own, and those below in which a linked set may lie."""
        while self.edges[-1] <= size:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * GROWTH)))
        own = int(np.searchsorted(self.edges, size, side="right")) - 1
        return [c for c in range(own, -1, -1) if c == own or (self.edges[c + 1] - 1) * self.den >= size * self.num]

    def parts(self, tokens: np.ndarray) -> np.ndarray:
        """Signatures of the parts. ``spare`` parts more than can differ; so many may be empty without being signed."""
        out = []
        for c in self.classes(len(tokens)):
            differ = (self.edges[c + 1] - 1) * (self.den - self.num) // self.num
            spare = 1 + differ // 16
            n = differ + 1 + spare
            seed = np.uint64(int(ODD) * (c + 1) % (1 << 64))
            at = (mixed(tokens + seed) % np.uint64(n)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            sizes = np.bincount(at, minlength=n)
            full = np.flatnonzero(sizes)
            sums = np.add.reduceat(mixed(tokens[order] ^ np.uint64(0x5851F42D4C957F2D)), (np.cumsum(sizes) - sizes)[full])
            place = mixed(np.arange(n, dtype=np.uint64) * ODD + np.uint64(c))
            out.append(mixed(sums ^ place[full]))
            if n - len(full) > spare:
                out.append(mixed(place[sizes == 0] + np.uint64(1)))
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def _named(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Two hashes of each set; the first is its node, the second tells apart different sets of one node."""
    return [int(np.bitwise_xor.reduce(mixed(s))) ^ len(s) for s in sets], [int(np.add.reduce(mixed(s ^ ODD))) for s in sets]


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the tokens' numbers in at least as many classes as there are tokens, a power of two and at least 512:
    two sketches never differ in more bits than their sets in tokens. Half a sketch is one half exclusive-or the other."""
    bits = max(512, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount((mixed(tokens ^ SKETCHED) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


class Sketches:
    """Sketches of several lengths as one array of 64-bit words per length."""

    def __init__(self, values: list[bytes]):
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 8
        self.level, self.row, self.tables = lengths, np.zeros(len(values), np.int64), {}
        for n in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == n)
            self.row[own] = np.arange(len(own))
            self.tables[n] = np.frombuffer(b"".join([values[k] for k in own]), np.uint64).reshape(-1, n)

    def of(self, at: np.ndarray, length: int) -> np.ndarray:
        """Sketches cut to ``length`` words; none of them is shorter."""
        out = np.empty((len(at), length), np.uint64)
        for n in np.unique(self.level[at]).tolist():
            own = np.flatnonzero(self.level[at] == n)
            x = self.tables[n][self.row[at[own]]]
            while x.shape[1] > length:
                x = x[:, :x.shape[1] // 2] ^ x[:, x.shape[1] // 2:]
            out[own] = x
        return out


def _nodes(size: int):
    """Each document's set size, node and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in byte_slices(batches, "text"):
            sets = [shingle_set(hashes.of(t.lower().split()), size) for t in raw_texts(batch.column("text"))]
            node, check = _named(sets)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), _signed(node), _signed(check),
                                              pa.array([sketch(s) for s in sets], pa.binary())], ["doc_id", "n_shingles", "node", "check", "sketch"])

    return run


def _parts(size: int, num: int, den: int):
    """The parts of each node of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, dealer = WordHashes(), Dealer(num, den)
        for batch in byte_slices(batches, "text"):
            sets = [shingle_set(hashes.of(t.lower().split()), size) for t in raw_texts(batch.column("text"))]
            parts: dict[int, np.ndarray] = {}
            for s, name in zip(sets, _named(sets)[0]):
                if len(s) and name not in parts:
                    parts[name] = np.unique(dealer.parts(s)).view(np.int64)
            yield pa.RecordBatch.from_arrays([_signed(list(parts)), pa.array(list(parts.values()), pa.list_(pa.int64()))], ["node", "parts"])

    return run


def close(sketches: Sketches, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs may be linked: their sizes are near enough, and their sketches differ in no more bits than linked sets
    of their sizes in tokens."""
    good = np.minimum(sizes[a], sizes[b]) * den >= np.maximum(sizes[a], sizes[b]) * num
    some = np.flatnonzero(good)
    length = np.minimum(sketches.level[a[some]], sketches.level[b[some]])
    for n in np.unique(length).tolist():
        own = some[length == n]
        x, y = a[own], b[own]
        differ = np.bitwise_count(sketches.of(x, n) ^ sketches.of(y, n)).sum(1, dtype=np.int64)
        good[own] = differ * (num + den) <= (sizes[x] + sizes[y]) * (den - num)
    return good


def meeting_pairs(sketches: Sketches, sizes: np.ndarray, block: np.ndarray, at: np.ndarray, i: int, j: int, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one part's nodes (the rows ``at``) that may be linked; of the blocks i and j where it has several."""
    left, right = at[block[at] == i], at[block[at] == j]
    for k in range(0, len(left), 64):
        a = np.repeat(left[k:k + 64], len(right))
        b = np.tile(right, len(left[k:k + 64]))
        if i == j:
            a, b = a[a < b], b[a < b]
        good = close(sketches, sizes, a, b, num, den)
        yield a[good], b[good]


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of different ``left`` and ``right`` indexes) with ``den * intersection >= num * union``.

    Columns are the tokens that several sets have. A row opens the other side only if its overlap with that side's
    token union reaches ``num / den`` of it.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    width = int(column.max()) + 1 if len(column) else 0

    def opened(side: np.ndarray, other: np.ndarray) -> np.ndarray:
        inside = np.zeros(len(sets), bool)
        inside[other] = True
        union = np.bincount(column[inside[row]], minlength=width) > 0
        overlap = np.bincount(row[union[column]], minlength=len(sets))
        return side[overlap[side] * den >= num * sizes[side]]

    left, right = opened(left, right), opened(right, left)
    if not len(left) or not len(right):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    place_l, place_r = np.full(len(sets), -1), np.full(len(sets), -1)
    place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
    for start in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        r, c = row[a:b], column[a:b] - start
        sides = []
        for place, n in ((place_l, len(left)), (place_r, len(right))):
            block = np.zeros((n, min(COLUMNS, width - start)), np.float32)
            mine = place[r] >= 0
            block[place[r][mine], c[mine]] = 1
            sides.append(block)
        common += sides[0] @ sides[1].T
    common = common.astype(np.int64)
    union = sizes[left][:, None] + sizes[right][None, :] - common
    a, b = np.nonzero(common * den >= num * union)
    a, b = left[a], right[b]
    return a[a != b], b[a != b]


def forest(pairs: Iterable[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs."""
    up, out = list(range(n)), []

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            up[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def join(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row: the size of its shingle set, the smallest id reachable by
    links, and the number of other rows it is linked with.

    A-Z is lower-cased and words are runs of anything but ASCII white space. Sets link when ``den * intersection >=
    num * union``; a row without words or text links with nothing. Rows with one id are told apart by their sets, but
    reach each other's links only through links. A row with a null id has a null component and links nothing (it has 0 links). Other
    columns are ignored.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    nodes = staged(rows.mapInArrow(_nodes(size), NODE_SCHEMA))
    by_part = Window.partitionBy("part")
    signed = rows.mapInArrow(_parts(size, num, den), MEETING_SCHEMA).select(F.explode("parts").alias("part"), "node")
    shared = (signed.withColumn("least", F.min("node").over(by_part)).withColumn("most", F.max("node").over(by_part))
              .where("least <> most").select("part", "node").distinct())
    shared = staged(shared.withColumn("blocks", F.ceil(F.count(F.lit(1)).over(by_part) / MEETING_ROWS).cast("int")))
    sketched = nodes.where("n_shingles > 0").groupBy("node").agg(F.first("sketch").alias("sketch"), F.first("n_shingles").alias("size"))
    tasks = max(1, shared.count() // (4 * MEETING_ROWS))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (shared.join(sketched, "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
           .withColumn("__other", other).withColumn("i", F.least("block", "__other")).withColumn("j", F.greatest("block", "__other"))
           .withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("part"), F.lit(tasks))).otherwise(F.xxhash64("part", "i", "j")))
           .select("task", "part", "i", "j", "block", "node", "size", "sketch"))

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("i", "ascending"), ("j", "ascending")])
        key = np.stack([table[c].to_numpy() for c in ("part", "i", "j")])
        starts = np.concatenate(([0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1))
        ends = np.append(starts[1:], table.num_rows)
        names, sizes, block = (table[c].to_numpy() for c in ("node", "size", "block"))
        bits = Sketches(table["sketch"].to_pylist())
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        two = starts[ends - starts == 2]
        good = close(bits, sizes, two, two + 1, num, den) & (block[two] == key[1, two]) & (key[1, two] == key[2, two])
        found.append((two[good], two[good] + 1))
        for a, b in zip(starts, ends):
            if b - a > 2 or b - a == 2 and key[1, a] != key[2, a]:
                found += meeting_pairs(bits, sizes, block, np.arange(a, b), key[1, a], key[2, a], num, den)
        x, y = (names[np.concatenate(side)] for side in zip(*found))
        pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
        own, back = np.unique(pairs, return_inverse=True)
        back = back.reshape(pairs.shape)
        tree = forest(zip(back[0].tolist(), back[1].tolist()), len(own))
        return pa.table([pa.array([own[u] for u, _ in tree], pa.int64()), pa.array([own[v] for _, v in tree], pa.int64())], ["a", "b"])

    grouped = components(met.groupBy("task").applyInArrow(meet, "a long, b long"))
    grouped = staged(grouped.unionByName(grouped.select(F.col("root").alias("node"), "root").distinct()))

    known = nodes.where("n_shingles > 0").groupBy("node", "check", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.count("doc_id").alias("copies"))
    members = known.where("doc_id IS NOT NULL").join(grouped, "node")
    shape = members.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("tokens"))
    blocks = shape.where("m > 1").select("root", F.greatest(F.ceil(F.col("m") / BLOCK_MEMBERS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    tasks = max(1, (shape.agg(F.sum("tokens")).first()[0] or 0) // BLOCK_TOKENS)  # of groups with one block
    placed = members.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("node", "check"), F.col("blocks")).cast("int"))
    texts = rows.where("doc_id IS NOT NULL").join(placed, "doc_id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in byte_slices(batches, "text"):
            own = [shingle_set(hashes.of(t.lower().split()), size) for t in raw_texts(batch.column("text"))]
            sums = np.array([int(np.add.reduce(mixed(s ^ ODD))) for s in own], np.uint64).view(np.int64)
            mine = pa.array(sums == batch.column("check").to_numpy())  # another text of the same id is another node
            out = pa.RecordBatch.from_arrays([*batch.drop_columns(["text"]).columns, pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64()))],
                                             [*batch.drop_columns(["text"]).schema.names, "tokens"])
            yield out.filter(mine)

    held = (texts.select("node", "root", "blocks", "block", "check", "copies", "text")
            .mapInArrow(sets, "node long, root long, blocks int, block int, check long, copies long, tokens array<long>").drop("check"))
    # A block meets every block of its group: as (i, j) with i <= j it is needed once for each other one.
    pairs = (held.withColumn("__other", other).withColumn("i", F.least("block", "__other")).withColumn("j", F.greatest("block", "__other"))
             .withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(tasks))).otherwise(F.xxhash64("root", "i", "j")))
             .select("task", "root", "i", "j", "block", "node", "copies", "tokens"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("root", "ascending"), ("i", "ascending"), ("j", "ascending"), ("node", "ascending")])
        key = np.stack([table[c].to_numpy() for c in ("root", "i", "j")])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        tokens, names, block = table["tokens"].combine_chunks(), table["node"].to_numpy(), table["block"].to_numpy()
        flat, ends = tokens.flatten().to_numpy().view(np.uint64), np.concatenate(([0], np.cumsum(tokens.value_lengths().to_numpy())))
        copies, edges, links = table["copies"].to_numpy(), [], []
        for a, b in zip([0, *cuts], [*cuts, table.num_rows]):
            own = [flat[ends[k]:ends[k + 1]] for k in range(a, b)]
            i, j = key[1, a], key[2, a]
            left, right = (np.flatnonzero(block[a:b] == x) for x in (i, j))
            if not len(left) or not len(right):
                continue
            x, y = linked(own, left, right, num, den)
            number = np.bincount(x, copies[a:b][y], b - a)
            if i != j:
                number += np.bincount(y, copies[a:b][x], b - a)
            some = np.flatnonzero(number)
            links += zip(names[a:b][some].tolist(), number[some].astype(np.int64).tolist())
            edges += [(names[a + u], names[a + v]) for u, v in forest(zip(x.tolist(), y.tolist()), b - a)]
        return pa.table([pa.array([u for u, _ in (*edges, *links)], pa.int64()), pa.array([v for _, v in edges] + [None] * len(links), pa.int64()),
                         pa.array([None] * len(edges) + [n for _, n in links], pa.int64())], ["a", "b", "links"])

    # Of the links only a spanning forest of each pair of blocks leaves the task, and their number per node.
    results = staged(pairs.groupBy("task").applyInArrow(compare, "a long, b long, links long"))
    found = components(results.where("b IS NOT NULL").select("a", "b"))
    numbers = results.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("__links"))
    labels = nodes.where("n_shingles > 0").groupBy("node", "check", "n_shingles").agg(F.min("doc_id").alias("least"), F.count("doc_id").alias("copies"))
    rooted = labels.join(found, "node", "left").join(numbers, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    known_row = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    n_links = F.when(known_row, F.col("copies") - 1 + F.coalesce("__links", F.lit(0))).otherwise(F.lit(0))
    return (nodes.select("doc_id", "n_shingles", "node", "check")
            .join(named.select("node", "check", "n_shingles", "component_id", "copies", "__links"), ["node", "check", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.when(known_row, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), n_links.alias("n_links")))
