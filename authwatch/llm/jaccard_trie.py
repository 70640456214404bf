"""N-gram Jaccard join on a prefix tree, and the components of its links.

A document's set are its distinct 5-word shingles. Texts with equal sets form
one class. Candidates: shingles have one global order, in which frequent ones
come late, and sets that reach the similarity share a shingle among the first
of each (prefix filter). Shared prefix shingles are counted per pair, and length
and position bounds drop most pairs; a shingle that very many classes have in
their prefix links its classes to one of them. This only says which classes may
meet: each connected group of candidates goes to one task, where its ordered
sets form a trie. All sets that are looked up take each node at once: the overlap of
common beginnings is counted once, a set leaves a subtree by the bounds on what is left,
or where it is linked with all of it already. A group of very many classes is split into blocks:
each block is joined alone, and classes outside the leading component are then
looked up in all blocks, a chunk of them at a time, so no link is lost and a task
holds one block and one chunk.

``link_counts`` also counts every link. Links lie within components, so the linked
classes meet once more by component, in blocks of like sizes, and each set is
counted in a trie without skipping: a subtree whose sets all are similar to it is
counted as a whole, on either side. No pair is written.

A null or wordless text has an empty set and is linked with nothing. Null ids
count as the largest. Repeated rows are copies of one another. Texts of any length
are taken whole, and an empty table gives no rows. Other columns are ignored. Shingles and classes are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authwatch.llm.batches import encoded, keep_table, map_batches, type_of
from authwatch.llm.components import components
from authwatch.llm.rolling import PrefixHash, mix
from authwatch.llm.words import word_bounds

SHINGLE = 5
#: Documents that share a shingle from which it counts as frequent; doubled until
#: at most ``MOST_FREQUENT`` shingles do, which are broadcast.
FREQUENT, MOST_FREQUENT = 64, 1 << 20
#: Classes of one prefix shingle that are paired; more are linked to one of them.
PAIRED = 64
#: Classes of a block of a large group.
BLOCK = 2048
#: Ranks whose holders are kept as bits while a trie is visited; of later ones as lists.
EARLY = 4096
#: Bits per member of the filter that keeps sets of unlinked classes at home, and the
#: words of 64 bits that it has at most (8 MB): beyond, more sets are shuffled in vain.
FILTER_BITS, FILTER_WORDS = 16, 1 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


# -- sets --------------------------------------------------------------------

def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct shingle hashes of all texts, and the bounds of the texts."""
    parts = [text.translate(_LOWER) for text in encoded(column)]
    joined, starts, stops, bounds = word_bounds(parts)
    words = mix(PrefixHash(joined).of(starts, stops) + (stops - starts).astype(np.uint64))
    sizes = np.diff(bounds)
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, (sizes > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(sizes)), counts)
    begin = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[owner]
    length = np.minimum(sizes, SHINGLE)[owner]
    hashes = mix(PrefixHash(words).of(begin, begin + length) + length.astype(np.uint64))
    ends = np.cumsum(counts)
    for begin, end in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        hashes[begin:end].sort()  # in place, text by text
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(sizes) + 1))


def signature(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "big", signed=True)


def distinct_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Signature and set of each class of a batch; empty sets are left out."""
    hashes, bounds = shingle_sets(column)
    seen = set()
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = hashes[begin:end]
        if begin < end and (sign := signature(own)) not in seen:
            seen.add(sign)
            yield sign, own


def _profile(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    hashes, bounds = shingle_sets(batch.column(1))
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(np.diff(bounds)),
         pa.array([signature(hashes[a:b]) for a, b in zip(
             bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.int64())],
        ["doc", "n", "sign"])


# -- candidates --------------------------------------------------------------

def _in_zone(hashes: np.ndarray) -> np.ndarray:
    """The half of all shingles among which frequent ones are told apart."""
    return hashes < np.uint64(1 << 63)


def _zone_counts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sets = [own[_in_zone(own)] for _, own in distinct_sets(batch.column(0))]
    if sets:
        shingles, counts = np.unique(np.concatenate(sets), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(shingles.view(np.int64)), pa.array(counts.astype(np.int32))],
            ["shingle", "n"])


def frequent_shingles(texts: DataFrame) -> np.ndarray:
    """Shingles that come late in the order, ascending; at most ``MOST_FREQUENT``."""
    counts = keep_table(
        map_batches(texts, _zone_counts, "shingle long, n int").groupBy("shingle")
        .agg(F.sum("n").alias("n")).filter(F.col("n") > FREQUENT))
    limit = FREQUENT
    while counts.filter(F.col("n") > limit).count() > MOST_FREQUENT:
        limit *= 2
    found = counts.filter(F.col("n") > limit).select("shingle").toPandas()["shingle"].to_numpy(
        np.int64)
    return np.sort(found.view(np.uint64))


def ordered(own: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set in the global order, with the order as ascending signed keys: ordinary
    shingles of the zone, frequent ones, then those beyond the zone."""
    late = np.zeros(len(own), bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        late = frequent[at] == own
    half = np.uint64(1)
    keys = own.view(np.int64) + np.int64(-1 << 63)
    keys = np.where(_in_zone(own), keys, (own >> half).view(np.int64))
    keys = np.where(late, (own >> half).view(np.int64), keys)
    order = np.argsort(keys, kind="stable")
    return own[order], keys[order]


def prefix_length(size):
    """Shingles of which one is shared by any two sets of similarity 0.75."""
    return size - (3 * size + 3) // 4 + 1


def _prefixes(frequent):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = [[], [], [], [], []]
        for sign, own in distinct_sets(batch.column(0)):
            most = prefix_length(len(own))
            shingles, keys = ordered(own, frequent.value)
            columns[0].append(shingles[:most].view(np.int64))
            for column, value in zip(columns[1:4], (sign, len(own), keys[most - 1]), strict=True):
                column.append(np.full(most, value, np.int64))
            columns[4].append(np.arange(1, most + 1))
        if columns[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(np.int32) if i in (2, 4)
                          else np.concatenate(c)) for i, c in enumerate(columns)],
                ["shingle", "sign", "n", "last", "place"])
    return run


#: A bound that no pair fails.
ALWAYS = 1 << 30


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of classes by shared prefix shingle, from rows in order of shingle and class."""
    rest: np.ndarray | None = None
    hub: tuple[int, int] | None = None  # (shingle, class) of a group that is only linked
    for batch in batches:
        rows = np.column_stack([c.to_numpy().astype(np.int64) for c in batch.columns])
        if rest is not None:
            rows = np.concatenate([rest, rows])
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        rows = rows[fresh]
        last = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
        rest = rows[last:]
        hub, out = yield_pairs(rows[:last], hub)
        yield from out
        if len(rest) > PAIRED or (hub and hub[0] == rest[0, 0]):
            # Too large to wait for its end.
            hub = hub if hub and hub[0] == rest[0, 0] else (int(rest[0, 0]), int(rest[0, 1]))
            yield from _links(hub[1], rest)
            rest = None
    if rest is not None:
        yield from yield_pairs(rest, hub)[1]


def _links(center: int, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(rows):
        yield _pair_batch(np.full(len(rows), center), rows[:, 1], rows[:, 2], rows[:, 2],
                          np.full(len(rows), ALWAYS), rows[:, 4], rows[:, 4])


def _pair_batch(a, b, n_a, n_b, slack, place_a, place_b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b), *(pa.array(x.astype(np.int32)) for x in (
            n_a, n_b, slack, place_a, place_b))],
        ["a", "b", "n_a", "n_b", "slack", "place_a", "place_b"])


def yield_pairs(rows: np.ndarray, hub):
    """Batches for whole groups; a group of ``hub`` goes on being linked."""
    out: list[pa.RecordBatch] = []
    if not len(rows):
        return hub, out
    begins = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
    sizes = np.diff(np.append(begins, len(rows)))
    if hub and hub[0] == rows[0, 0]:
        out += _links(hub[1], rows[:sizes[0]])
        sizes[0] = 0
    for begin, size in zip(begins[sizes > PAIRED].tolist(), sizes[sizes > PAIRED].tolist(),
                           strict=True):
        out += _links(int(rows[begin, 1]), rows[begin + 1:begin + size])
    for size in np.unique(sizes[(sizes > 1) & (sizes <= PAIRED)]).tolist():
        first, second = np.triu_indices(size, 1)
        groups = begins[sizes == size]
        for part in np.array_split(groups, len(groups) * len(first) // 200_000 + 1):
            left = rows[(part[:, None] + first).ravel()]
            right = rows[(part[:, None] + second).ravel()]
            fits = 4 * np.minimum(left[:, 2], right[:, 2]) >= 3 * np.maximum(left[:, 2],
                                                                             right[:, 2])
            left, right = left[fits], right[fits]
            if len(left):
                # After its prefix, the set whose prefix ends first has so much left.
                after_left = left[:, 2] - prefix_length(left[:, 2])
                after_right = right[:, 2] - prefix_length(right[:, 2])
                slack = np.where(left[:, 3] < right[:, 3], after_left, np.where(
                    left[:, 3] > right[:, 3], after_right, np.minimum(after_left, after_right)))
                out.append(_pair_batch(left[:, 1], right[:, 1], left[:, 2], right[:, 2], slack,
                                       left[:, 4], right[:, 4]))
    return None if hub and hub[0] != rows[-1, 0] else hub, out


def candidate_pairs(texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that connect all classes that may be similar."""
    frequent = texts.sparkSession.sparkContext.broadcast(frequent_shingles(texts))
    rows = map_batches(texts, _prefixes(frequent),
                       "shingle long, sign long, n int, last long, place int")
    shared = (rows.repartition("shingle").sortWithinPartitions("shingle", "sign")
              .mapInArrow(_pairs, "a long, b long, n_a int, n_b int, slack int, place_a int, "
                                  "place_b int"))
    common = F.count("*")
    most = F.least(F.max("slack"), F.max("n_a") - F.max("place_a"),
                   F.max("n_b") - F.max("place_b"))
    return (shared.groupBy("a", "b")
            .agg((common + F.when(F.max("slack") == ALWAYS, ALWAYS).otherwise(most)).alias("most"),
                 F.max("n_a").cast("long").alias("n_a"), F.max("n_b").cast("long").alias("n_b"))
            .filter(7 * F.col("most") >= 3 * (F.col("n_a") + F.col("n_b"))).select("a", "b"))


# -- the trie ----------------------------------------------------------------

class Node:
    """A run of shingles that all sets below it share."""

    __slots__ = ("run", "children", "items", "low", "high", "first", "last",
                 "weight", "here", "below")

    def __init__(self, run: tuple[int, ...], size: int):
        self.run, self.children, self.items = run, {}, []
        self.low = self.high = size
        # Where the items below stand in ``Trie.order``.
        self.first = self.last = 0
        # Weight of the sets below; what was counted for those that end here, and for all.
        self.weight = self.here = self.below = 0


class Probes:
    """Sets that go through a trie side by side: ascending tuples of ranks."""

    def __init__(self, sets: list[tuple[int, ...]]):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        ranks = np.fromiter(chain.from_iterable(sets), np.int64, int(self.sizes.sum()))
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.span = int(ranks.max(initial=0)) + 1
        self.keys = owner * self.span + ranks
        early = ranks < EARLY
        self.bits = np.zeros((len(sets), min(EARLY, self.span) // 64 + 1), np.uint64)
        np.bitwise_or.at(self.bits, (owner[early], ranks[early] >> 6), _bit(ranks[early]))
        late = np.argsort(ranks[~early], kind="stable")
        self.holders = owner[~early][late]
        self.held = np.searchsorted(ranks[~early][late], np.arange(EARLY, self.span + 1))

    def shared(self, run: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """How many shingles of ``run`` each chosen set has."""
        cut = int(np.searchsorted(run, min(EARLY, self.span)))
        own, rest = run[:cut], run[cut:]
        out = np.zeros(len(chosen), np.int64)
        if cut:
            first, last = int(own[0]) >> 6, (int(own[-1]) >> 6) + 1
            mask = np.zeros(last - first, np.uint64)
            np.bitwise_or.at(mask, (own >> 6) - first, _bit(own))
            bits = self.bits[:, first:last]
            bits = bits if len(chosen) == len(bits) else bits[chosen]
            out += np.bitwise_count(bits & mask).sum(axis=1, dtype=np.int64)
        rest = rest[rest < self.span] - EARLY
        if len(rest):
            begins = self.held[rest]
            counts = self.held[rest + 1] - begins
            at = np.repeat(begins - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            if len(at):
                out += np.bincount(self.holders[at], minlength=len(self.sizes))[chosen]
        return out

    def passed(self, rank: int, chosen: np.ndarray) -> np.ndarray:
        """How many shingles each chosen set has up to ``rank``."""
        rank = min(rank, self.span - 1)
        return np.searchsorted(self.keys, chosen * self.span + rank, "right") - self.begins[chosen]


def _bit(ranks: np.ndarray) -> np.ndarray:
    return np.left_shift(np.uint64(1), (ranks & 63).astype(np.uint64))


class Trie:
    """Sets as ascending tuples of ranks."""

    def __init__(self, sets: list[tuple[int, ...]]):
        self.root = Node((), len(sets[0]))
        for item, ranks in enumerate(sets):
            self._add(item, ranks)
        self.order: list[int] = []
        for node in self.nodes():
            node.first = len(self.order)
            self.order += node.items
            node.last = len(self.order)
        for node in reversed([*self.nodes()]):
            node.last = max([node.last, *(child.last for child in node.children.values())])

    def _add(self, item: int, ranks: tuple[int, ...]) -> None:
        node, at = self.root, 0
        while True:
            node.low, node.high = min(node.low, len(ranks)), max(node.high, len(ranks))
            if at == len(ranks):
                node.items.append(item)
                return
            child = node.children.get(ranks[at])
            if child is None:
                leaf = Node(ranks[at:], len(ranks))
                leaf.items.append(item)
                node.children[ranks[at]] = leaf
                return
            run, same = child.run, 0
            limit = min(len(run), len(ranks) - at)
            while same < limit and run[same] == ranks[at + same]:
                same += 1
            if same < len(run):
                upper = Node(run[:same], child.low)
                upper.high = child.high
                upper.children[run[same]] = child
                child.run = run[same:]
                node.children[run[0]] = child = upper
            node, at = child, at + same

    def nodes(self) -> Iterator[Node]:
        """All nodes, upper ones first."""
        stack = [self.root]
        while stack:
            yield (node := stack.pop())
            stack += node.children.values()

    def visit(self, probes: Probes, wanted=None) -> Iterator[tuple[Node, np.ndarray, np.ndarray]]:
        """Nodes with the probes that are similar to all sets below, and with those, among the
        others, that are similar to the sets that end there.

        All probes take a node at once, so the overlap of common beginnings is counted once.
        A probe goes no further than the bounds on what is left allow, and ``wanted`` tells
        which ones have to see a node.
        """
        every = np.arange(len(probes.sizes))
        stack = [(self.root, 0, every, np.zeros(len(every), np.int64))]
        while stack:
            node, depth, chosen, shared = stack.pop()
            if wanted is not None:
                kept = wanted(node, chosen)
                chosen, shared = chosen[kept], shared[kept]
            if not len(chosen):
                continue
            size = probes.sizes[chosen]
            if node.run:
                run = np.array(node.run)
                depth += len(run)
                shared = shared + probes.shared(run, chosen)
                # At most all of what is left can be shared, on either side.
                kept = 4 * node.high >= 3 * size + 7 * (depth - shared)
                if node.children:
                    passed = probes.passed(node.run[-1], chosen)
                    kept &= 4 * size >= 3 * node.low + 7 * (passed - shared)
                chosen, shared, size = chosen[kept], shared[kept], size[kept]
            # Enough is shared already, whatever follows.
            whole = 7 * shared >= 3 * (size + node.high)
            rest, shared = chosen[~whole], shared[~whole]
            here = rest[7 * shared >= 3 * (size[~whole] + depth)] if node.items else rest[:0]
            if whole.any() or len(here):
                yield node, chosen[whole], here
            if len(rest):
                stack += [(child, depth, rest, shared) for child in node.children.values()]

    def weigh(self, weights: np.ndarray) -> None:
        sums = np.concatenate([[0], np.cumsum(weights[self.order])]).tolist()
        for node in self.nodes():
            node.weight = sums[node.last] - sums[node.first]

    def counted(self) -> Iterator[tuple[int, int]]:
        """What was noted at each set; to be read once."""
        for node in self.nodes():
            for child in node.children.values():
                child.below += node.below
            for item in node.items:
                yield item, node.here + node.below


def ranked(sets: list[np.ndarray]) -> list[tuple[int, ...]]:
    """Sets by rank in one order: shingles of many sets first, so that beginnings are shared."""
    found, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(found), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(found))
    bounds = np.cumsum([len(own) for own in sets])[:-1]
    return [tuple(np.sort(own).tolist()) for own in np.split(rank[at], bounds)]


def join_sets(sets: list[np.ndarray], labels: list[int] | None = None,
              probes: int = 0) -> Iterator[tuple[int, int]]:
    """Pairs of similar items that connect all similar ones.

    With ``labels``, items of one label count as linked, and only the last
    ``probes`` items are looked up, among the others. Subtrees whose sets are linked
    with a probe already are not visited by it.
    """
    stored = len(sets) - probes
    if not stored:
        return
    known = np.arange(len(sets)) if labels is None else np.unique(labels, return_inverse=True)[1]
    plain = ranked(sets)
    trie = Trie(plain[:stored])
    asked = np.arange(stored if probes else 0, len(sets))
    order = np.array(trie.order)

    def wanted(node: Node, chosen: np.ndarray) -> np.ndarray:
        below = known[order[node.first:node.last]]
        if (below != below[0]).any():
            return np.ones(len(chosen), bool)
        return known[asked[chosen]] != below[0]

    for node, whole, here in trie.visit(Probes([plain[x] for x in asked]), wanted):
        for near, items in ((whole, order[node.first:node.last]), (here, np.array(node.items))):
            if not len(near):
                continue
            both = np.concatenate([asked[near], items])
            tags, first = np.unique(known[both], return_index=True)
            if len(tags) == 1:
                continue
            # All of one side are similar to all of the other one.
            probe, item, own = int(asked[near[0]]), int(items[0]), known[asked[near[0]]]
            if known[item] != own:
                yield probe, item
            for tag, at in zip(tags.tolist(), first.tolist(), strict=True):
                if tag not in (own, known[item]):
                    yield (int(both[at]), item) if at < len(near) else (probe, int(both[at]))
            known[np.isin(known, tags)] = own


def count_sets(sets: list[np.ndarray], weights: list[int], probes: int | None) -> list[int]:
    """For each item the weight of its similar items: of all and itself, or, with
    ``probes``, of the last ``probes`` items for the others and the other way round."""
    stored = len(sets) - (probes or 0)
    totals = [0] * len(sets)
    if not stored or probes == 0:
        return totals
    plain = ranked(sets)
    trie = Trie(plain[:stored])
    weigh = np.array(weights, np.int64)
    trie.weigh(weigh)
    asked = 0 if probes is None else stored
    own, found = weigh[asked:], np.zeros(len(sets) - asked, np.int64)
    for node, whole, here in trie.visit(Probes(plain[asked:])):
        node.below += int(own[whole].sum())
        node.here += int(own[here].sum())
        found[whole] += node.weight
        found[here] += int(weigh[node.items].sum())
    totals[asked:] = found.tolist()
    if probes is not None:
        for item, total in trie.counted():
            totals[item] = total
    return totals


def as_stars(pairs: Iterable[tuple[int, int]]) -> dict[int, int]:
    """Pairs as item -> least item of its component, which is left out itself."""
    root: dict[int, int] = {}

    def find(item: int) -> int:
        while (above := root.get(item, item)) != item:
            root[item] = root.get(above, above)
            item = above
        return item

    for left, right in pairs:
        left, right = find(left), find(right)
        if left != right:
            root[max(left, right)] = min(left, right)
    return {item: find(item) for item in root}


def _join_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each (group, block, chunk of probes), from rows in that order, probes
    last: at most a block and a chunk at once."""
    def rows():
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

    for _, members in groupby(rows(), key=lambda row: row[:3]):
        members = list(members)
        signs = [row[4] for row in members]
        sets = [np.frombuffer(row[6], np.uint64) for row in members]
        probes = sum(row[3] for row in members)
        labels = [row[5] for row in members] if members[0][5] is not None else None
        if probes == len(members):
            continue
        stars = as_stars(((signs[a], signs[b]) for a, b in join_sets(sets, labels, probes)))
        if stars:
            yield pa.RecordBatch.from_arrays(
                [pa.array(stars.keys(), pa.int64()), pa.array(stars.values(), pa.int64())],
                ["a", "b"])


def _in_groups(rows: DataFrame) -> DataFrame:
    return (rows.select("group", "block", "chunk", "probe", "sign", "label", "shingles")
            .repartition("group", "block", "chunk")
            .sortWithinPartitions("group", "block", "chunk", "probe", "sign")
            .mapInArrow(_join_groups, "a long, b long"))


#: The two blocks that meet in a task; equal for a block with itself.
MEETING = ("root", "band", "part", "other_band", "other_part")


def _count_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight linked with each class in each meeting of two blocks, from rows in that order,
    probes last."""
    def rows():
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

    def table():
        return pa.RecordBatch.from_arrays(
            [pa.array(signs, pa.int64()), pa.array(totals, pa.int64())], ["sign", "links"])

    signs, totals = [], []
    for key, members in groupby(rows(), key=lambda row: row[:len(MEETING)]):
        probe, own, weights, sets = zip(*(row[len(MEETING):] for row in members), strict=True)
        signs += own
        totals += count_sets([np.frombuffer(x, np.uint64) for x in sets], list(weights),
                             None if key[1:3] == key[3:5] else sum(probe))
        if len(signs) >= BLOCK:
            yield table()
            signs, totals = [], []
    if signs:
        yield table()


# -- the operator ------------------------------------------------------------

def _filter_words(signs: DataFrame) -> np.ndarray:
    """A one-hash Bloom filter: it may let others pass, so it only saves shuffling."""
    wanted = signs.count() * FILTER_BITS // 64
    size = min(FILTER_WORDS, 1 << max(10, wanted.bit_length()))
    words = signs.select(
        F.pmod("sign", F.lit(size)).alias("word"),
        F.expr("shiftleft(1L, cast(pmod(shiftright(sign, 32), 64) as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(size, np.int64)
    table[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return table.view(np.uint64)


def _sets_of(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The set of each member, once: (sign, shingles, ...)."""
    wanted = texts.sparkSession.sparkContext.broadcast(_filter_words(members.select("sign")))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        found = [(sign, own.tobytes()) for sign, own in distinct_sets(batch.column(0))
                 if int(bits[sign % len(bits)]) >> ((sign >> 32) % 64) & 1]
        if found:
            signs, sets = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signs, pa.int64()), pa.array(sets, pa.binary())], ["sign", "shingles"])

    sets = map_batches(texts, run, "sign long, shingles binary")
    # Copies of a class bring the same set; joined first, so that few rows are left.
    return sets.join(members, "sign").dropDuplicates(["sign"])


def class_links(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, root) for every class that is similar to another one, roots left out, and
    the sets of all classes that may be: (sign, shingles, ...)."""
    groups = components(candidate_pairs(texts), "a", "b")
    members = groups.select(F.col("node").alias("sign"), F.col("root").alias("group")).unionByName(
        groups.select(F.col("root").alias("sign"), F.col("root").alias("group"))).distinct()
    sizes = members.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = members.join(sizes, "group").withColumn(
        "block", F.pmod(F.xxhash64("sign"), F.col("blocks")))
    rows = keep_table(_sets_of(texts, placed).withColumns({
        "probe": F.lit(0), "chunk": F.lit(0).cast("long"), "label": F.lit(None).cast("long")}))
    links = components(_in_groups(rows), "a", "b")
    large = rows.filter("blocks > 1").drop("label")
    if large.isEmpty():
        return links, rows

    def look_up(links: DataFrame, chosen: str) -> DataFrame:
        """Links after looking up one class per component, or all outside the leading one."""
        labelled = large.join(links.withColumnRenamed("node", "sign"), "sign", "left").withColumn(
            "label", F.coalesce("root", "sign")).drop("root")
        if chosen == "roots":
            asked = labelled.filter("label = sign")
        else:
            counts = labelled.groupBy("group", "label").agg(F.count("*").alias("n"))
            leading = counts.groupBy("group").agg(F.max_by("label", "n").alias("leading"))
            asked = labelled.join(leading, "group").filter("label != leading").drop("leading")
        # Every chunk of a group's probes meets every block of the group.
        chunks = asked.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).alias("chunks"))
        zero = F.lit(0).cast("long")
        probes = (asked.join(chunks, "group").withColumns({
            "probe": F.lit(1), "chunk": F.pmod(F.xxhash64("group", "sign"), F.col("chunks")),
            "block": F.explode(F.sequence(zero, F.col("blocks") - 1))}))
        held = labelled.join(chunks, "group").withColumn(
            "chunk", F.explode(F.sequence(zero, F.col("chunks") - 1)))
        new = _in_groups(held.unionByName(probes))
        return components(new.unionByName(links.select(
            F.col("node").alias("a"), F.col("root").alias("b"))), "a", "b")

    return look_up(look_up(links, "roots"), "others"), rows


#: Sets of similarity 0.75 are at most 4 / 3 as large as each other: in logarithms of a
#: little more, their bands are equal or neighbours.
BAND = 1.34


def class_counts(classes: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """(sign, links): the weight of the classes that each linked class is similar to, and
    its own. ``classes`` has (sign, n, weight), ``links`` (node, root)."""
    members = links.select(F.col("node").alias("sign"), "root").unionByName(
        links.select(F.col("root").alias("sign"), "root").distinct())
    placed = members.join(classes, "sign").withColumn(
        "band", F.floor(F.log("n") / F.log(F.lit(BAND))))
    sizes = placed.groupBy("root", "band").agg(F.count("*").alias("held"))
    large = sizes.groupBy("root").agg(F.sum("held").alias("all")).filter(F.col("all") > BLOCK)
    # Blocks of a band, for the band itself and its neighbours; components of one block have none.
    parts = (sizes.join(large, "root").withColumn("parts", F.ceil(F.col("held") / BLOCK))
             .select("root", F.explode(F.array(*(
                 F.struct((F.col("band") + step).alias("band"), F.lit(-step).alias("step"),
                          "parts") for step in (-1, 0, 1)))).alias("near")))
    parts = parts.groupBy("root", "near.band").agg(*(
        F.coalesce(F.max(F.when(F.col("near.step") == step, F.col("near.parts"))),
                   F.lit(0).cast("long")).alias(name)
        for step, name in ((-1, "lower"), (0, "parts"), (1, "upper"))))
    zero = F.lit(0).cast("long")
    rows = placed.join(parts, ["root", "band"], "left").withColumns({
        "band": F.when(F.col("parts").isNull(), zero).otherwise(F.col("band")),
        "part": F.when(F.col("parts").isNull(), zero).otherwise(
            F.pmod(F.xxhash64("sign"), F.col("parts")))})

    def meetings(probe: int, step: int, first, last):
        """Blocks from ``first`` to before ``last`` of the band ``step`` away; the lower
        block of two is held, the upper one probes it."""
        def meeting(other):
            own, near = (F.col("band"), F.col("part")), (F.col("band") + step, other)
            (band, part), (other_band, other_part) = (near, own) if probe else (own, near)
            return F.struct(band.alias("band"), part.alias("part"),
                            other_band.alias("other_band"), other_part.alias("other_part"),
                            F.lit(probe).alias("probe"))
        return F.when(last > first, F.transform(F.sequence(first, last - 1), meeting)).otherwise(
            F.transform(F.array().cast("array<bigint>"), meeting))

    parts_of = {name: F.coalesce(F.col(name), zero) for name in ("lower", "upper")}
    own = F.col("part")
    met = F.explode(F.concat(
        meetings(0, 0, own, F.coalesce(F.col("parts"), F.lit(1).cast("long"))),
        meetings(0, 1, zero, parts_of["upper"]), meetings(1, 0, zero, own),
        meetings(1, -1, zero, parts_of["lower"])))
    dealt = (rows.join(sets.select("sign", "shingles"), "sign")
             .select("root", "sign", "weight", "shingles", met.alias("met"))
             .select("root", "met.band", "met.part", "met.other_band", "met.other_part",
                     "met.probe", "sign", "weight", "shingles"))
    return (dealt.repartition(*MEETING).sortWithinPartitions(*MEETING, "probe", "sign")
            .mapInArrow(_count_groups, "sign long, links long")
            .groupBy("sign").agg(F.sum("links").alias("links")))


def _profiles(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return keep_table(map_batches(
        docs.select(id_col, text_col), _profile, f"doc {type_of(docs, id_col)}, n long, sign long"))


def _with_components(profile: DataFrame, links: DataFrame, id_col: str) -> DataFrame:
    rooted = profile.join(links.withColumnRenamed("node", "sign"), "sign", "left").withColumn(
        "root", F.coalesce("root", "sign"))
    least = (rooted.filter("n > 0").groupBy("root").agg(F.min("doc").alias("least")))
    return rooted.join(least, "root", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"),
        F.col("sign").alias("class_id"))


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_shingles, component_id and the class it belongs to."""
    profile = _profiles(docs, id_col, text_col)
    return _with_components(profile, class_links(docs.select(text_col))[0], id_col)


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_shingles, component_id, class_id (the least id with an equal
    set; its own without words) and n_links, the number of other rows that it links with."""
    profile = _profiles(docs, id_col, text_col)
    links, sets = class_links(docs.select(text_col))
    links = keep_table(links)
    classes = profile.filter("n > 0").groupBy("sign").agg(
        F.first("n").alias("n"), F.count("*").alias("weight"), F.min("doc").alias("copy_of"))
    classes = keep_table(classes)
    counts = class_counts(classes.drop("copy_of"), links, sets)
    known = classes.join(counts, "sign", "left").select(
        F.col("sign").alias("class_id"), "copy_of",
        (F.coalesce("links", "weight") - 1).alias("others"))
    empty = F.col("n_shingles") == 0
    return _with_components(profile, links, id_col).join(known, "class_id", "left").select(
        id_col, "n_shingles", "component_id",
        F.when(empty, F.col(id_col)).otherwise(F.col("copy_of")).alias("class_id"),
        F.when(empty, 0).otherwise(F.col("others")).cast("long").alias("n_links"))
