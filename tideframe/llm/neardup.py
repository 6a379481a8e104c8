"""Near-duplicate classes by order MinHash and banded alignment.

1. One pass over the texts: words, k-mers numbered by occurrence, and ``SKETCHES`` order sketches. A sketch takes
   the k-mers of least hash under its own permutation and hashes them in text order, so it agrees for texts of
   small edit distance rather than for texts of equal word sets. k-mers are the shorter, the fewer words a text has
   (``TIERS``); texts near a border are sketched on both sides of it, so any two texts of similar length share a tier.
2. Equal texts become one node. Nodes with an equal sketch share a bucket.
3. Rounds: in every bucket with more than one class, all members are compared with one centre, the member that shares
   most buckets with others. Verified links join classes, which are contracted after every round, and whatever is then of one class
   needs no further comparison; a first round over the buckets of ``FIRST`` sketches joins most copies for the rounds over all buckets.
   A bucket of at most ``SMALL`` members compares the rest of its members across classes. A larger one goes on
   without its centre; after ``STARS`` rounds, or fewer if they settle little, its members are compared across classes too, in blocks: two
   texts are a candidate unless their lengths, the agreement of their signatures or their parities rule out a link. All candidates that are
   not of one class are compared, each in one of the buckets they share. Only where two blocks have more than ``CROWD`` for each member,
   ``NEAREST`` rounds come before that, which compare every member with its likeliest one. No bucket is cut off or split.
4. A candidate is a link if banded alignment of the words finds an edit similarity of ``SIMILARITY`` or more:
   1 - distance / longer length. The alignment keeps diagonals within the distance allowed only.

Candidates, links and classes stay distributed; intermediate tables are written to the folder in
``spark.checkpoint.dir``, so a lost executor costs its tasks only.

Defined cases: null texts count as empty; texts without a word are equal or not at all; texts of fewer than five words are one
k-mer; repeated ids and rows get one result row each; the class id is the least id of the class (nulls last);
an empty table has no classes; other columns are ignored by :func:`duplicate_classes` and kept by :func:`drop_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.llm.batches import in_batches
from tideframe.llm.tokens import each_text, mix, windows
from tideframe.session import discard, materialize

SKETCHES, SIMILARITY, SMALL, STARS = 48, 0.8, 12, 3
#: Sketches of the first round, rounds of likeliest candidates at most, candidates for each member of two blocks that are compared at once.
FIRST, NEAREST, CROWD = 6, 2, 20
#: Links that one task contracts by itself; a star round whose links are a smaller share of the rows in open buckets is the last.
FEW_LINKS, SETTLING = 20_000, 0.01
#: Most words of a text, words of a k-mer and minima of a sketch, from short texts to long ones.
TIERS = ((16, 1, 3), (64, 2, 2), (None, 3, 2))
#: Bytes of a signature (a minimum over the numbered words each), members of a block.
SIGNS, BLOCK = 64, 500
#: Bits of a parity; a power of two.
PARITY = 4096
#: Edits from which bits of whole columns are quicker than the places reached on diagonals.
MANY_EDITS = 12
_RNG = np.random.default_rng(3)
_MASKS = _RNG.integers(0, 2**63, SKETCHES, dtype=np.uint64)
_FACTORS = _RNG.integers(0, 2**63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RNG.integers(0, 2**63, max(t[2] for t in TIERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIGN_MASKS = _RNG.integers(0, 2**63, SIGNS, dtype=np.uint64)
_SIGN_FACTORS = _RNG.integers(0, 2**63, SIGNS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def number_occurrences(kmers: np.ndarray) -> np.ndarray:
    """k-mers told apart by how often they came before in the text."""
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    again = np.append(False, ordered[1:] == ordered[:-1])
    if not again.any():
        return kmers
    place = np.arange(len(kmers))
    first = np.maximum.accumulate(np.where(again, 0, place))
    occurrence = np.empty(len(kmers), dtype=np.uint64)
    occurrence[order] = (place - first).astype(np.uint64)
    return np.where(occurrence > 0, mix(kmers + occurrence), kmers)


def order_sketches(words: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The sketches of one text, as signed integers; none for a text without words, those of two tiers near a border."""
    if not len(words):
        return np.empty(0, dtype=np.int64)
    found, least = [], 0
    for number, (most, k, minima) in enumerate(TIERS):
        # a text of up to ``most`` words may be similar to one of up to ``most / similarity``
        if len(words) > least and (most is None or len(words) * similarity <= most + 1e-9):
            found.append(_tier_sketches(words, k, minima, number))
        least = most
    return np.concatenate(found)


def _tier_sketches(words: np.ndarray, k: int, minima: int, tier: int) -> np.ndarray:
    kmers = number_occurrences(windows(words, min(k, len(words))))
    taken = min(minima, len(kmers))
    out = np.empty(SKETCHES, dtype=np.uint64)
    step = max(1, 400_000 // len(kmers))
    for a in range(0, SKETCHES, step):
        b = min(a + step, SKETCHES)
        values = (kmers[None, :] ^ _MASKS[a:b, None]) * _FACTORS[a:b, None]
        least = np.empty((b - a, taken), dtype=np.int64)
        rows = np.arange(b - a)
        for j in range(taken):
            least[:, j] = values.argmin(axis=1)
            values[rows, least[:, j]] = np.uint64(2**64 - 1)
        least.sort(axis=1)  # text order
        turns = np.arange(a, b, dtype=np.uint64) + np.uint64(tier * SKETCHES)
        out[a:b] = (kmers[least] * _PLACES[:taken]).sum(axis=1, dtype=np.uint64) + turns
    return mix(out).view(np.int64)


def signature(words: np.ndarray) -> bytes:
    """One byte of each of ``SIGNS`` minima over the words numbered by occurrence."""
    if not len(words):
        return bytes(SIGNS)
    kmers = number_occurrences(windows(words, 1))
    out = np.empty(SIGNS, dtype=np.uint64)
    step = max(1, 400_000 // len(kmers))
    for a in range(0, SIGNS, step):
        b = min(a + step, SIGNS)
        out[a:b] = ((kmers[None, :] ^ _SIGN_MASKS[a:b, None]) * _SIGN_FACTORS[a:b, None]).min(axis=1)
    return (mix(out) & np.uint64(255)).astype(np.uint8).tobytes()


def parity(words: np.ndarray) -> bytes:
    """Whether the numbered words of each hash value are odd in number: texts that differ in n of them differ in n bits at most."""
    at = mix(number_occurrences(words)) & np.uint64(PARITY - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=PARITY) & 1).astype(np.uint8)).tobytes()


def least_signs(similarity: float) -> int:
    """Equal signature bytes of a link, but for five deviations: of links, similarity / (2 - similarity) of the words agree."""
    share = max(0.0, similarity / (2 - similarity))
    return int(SIGNS * share - 5 * (SIGNS * share * (1 - share)) ** 0.5)


def _bit_distance(a: list[int], b: list[int], limit: int) -> int:
    """Edit distance of two sequences, or ``limit + 1`` if it is larger, from the rises and falls along the rows of a column, a bit each (Myers)."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    whole, last, distance = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    up, down, left = whole, 0, len(b)
    for y in b:
        equal = places.get(y, 0)
        across = (((equal & up) + up) ^ up) | equal
        rise, fall = down | (whole & ~(across | up)), up & across
        distance += 1 if rise & last else -1 if fall & last else 0
        left -= 1
        if distance - left > limit:
            return limit + 1
        rise, fall, equal = rise << 1 | 1, fall << 1, equal | down
        up, down = (fall | ~(equal | rise)) & whole, rise & equal & whole
    return min(distance, limit + 1)


def edit_distance_within(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two word sequences, or ``limit + 1`` if it is larger.

    For every number of edits, the furthest place reached on each diagonal of the band is kept. Texts whose words alone tell of
    more than ``MANY_EDITS`` are compared column by column.
    """
    shared = min(len(a), len(b))
    other = np.flatnonzero(a[:shared] != b[:shared])
    head = int(other[0]) if len(other) else shared
    a, b = a[head:], b[head:]
    shared -= head
    other = np.flatnonzero(a[len(a) - shared :][::-1] != b[len(b) - shared :][::-1])
    tail = int(other[0]) if len(other) else shared
    a, b = a[: len(a) - tail].astype(np.int64), b[: len(b) - tail].astype(np.int64)
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return limit + 1
    if not n or not m:
        return max(n, m)
    if limit > 8:
        values, which = np.unique(np.concatenate([a, b]), return_inverse=True)
        surplus = np.bincount(which[:n], minlength=len(values)) - np.bincount(which[n:], minlength=len(values))
        least = max(surplus[surplus > 0].sum(), -surplus[surplus < 0].sum())
        if least > limit:
            return limit + 1
        if least > MANY_EDITS:
            return _bit_distance(a.tolist(), b.tolist(), limit)
    a, b = np.append(a, -1), np.append(b, -2)  # borders that never match
    goal, nowhere = m - n, -(1 << 40)
    reach = np.full(2 * limit + 5, nowhere)
    middle = limit + 2
    for edits in range(limit + 1):
        low = max(-edits, -n, goal - (limit - edits))
        high = min(edits, m, goal + (limit - edits))
        diagonals = np.arange(low, high + 1)
        at = diagonals + middle
        if edits:
            place = np.maximum(np.maximum(reach[at] + 1, reach[at + 1] + 1), reach[at - 1])
        else:
            place = np.zeros(len(at), dtype=np.int64)
        place = np.minimum(place, np.minimum(n, m - diagonals))
        moving = np.flatnonzero((place >= 0) & (place + diagonals >= 0))
        while len(moving):
            if len(moving) == 1:
                k = moving[0]
                i, j = int(place[k]), int(place[k] + diagonals[k])
                while True:
                    size = min(256, n - i, m - j)
                    other = np.flatnonzero(a[i : i + size] != b[j : j + size])
                    step = int(other[0]) if len(other) else size
                    i, j = i + step, j + step
                    if len(other) or not size:
                        break
                place[k] = i
                break
            moving = moving[a[place[moving]] == b[place[moving] + diagonals[moving]]]
            place[moving] += 1
        reach[at] = place
        if low <= goal <= high and reach[goal + middle] >= n:
            return edits
        reach[: low + middle] = nowhere
        reach[high + middle + 1 :] = nowhere
    return limit + 1


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the edit similarity of two word sequences reaches ``similarity``."""
    longer = max(len(a), len(b))
    limit = int((1 - similarity) * longer + 1e-9)
    return longer == 0 or edit_distance_within(a, b, limit) <= limit


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.unhex(F.md5(text)).alias("node"), text.alias("text"))


def sketch_documents(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, node (digest of the text), sketches, number of words, signature."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes, signs = [], [], []
            for _, h in each_text(batch.column(2).to_pylist()):
                found.append(order_sketches(h, similarity))
                sizes.append(len(h))
                signs.append(signature(h))
            offsets = np.append(0, np.cumsum([len(s) for s in found])).astype(np.int32)
            values = np.concatenate(found) if found else np.empty(0, np.int64)
            sketches = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            columns = [batch.column(0), batch.column(1), sketches, pa.array(sizes, pa.int64()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "sketches", "n_words", "signs"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(_texts(docs)).mapInArrow(sketch, f"doc_id {id_type}, node binary, sketches array<bigint>, n_words bigint, signs binary")


def _words_of(texts: DataFrame) -> DataFrame:
    """node, words (32 bits of each word's hash), their parity."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                found = [(h >> np.uint64(32)).astype(np.uint32) for _, h in each_text(part.column(1).to_pylist())]
                parities = pa.array([parity(h.astype(np.uint64)) for h in found], pa.binary())
                offsets = np.append(0, np.cumsum([len(s) for s in found])).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), values, parities], names=["node", "words", "parity"])

    return in_batches(texts.select("node", "text")).mapInArrow(words, "node binary, words array<int>, parity binary")


def _list_item(column: pa.ListArray, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


def verify(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            linked = [similar(_list_item(left, i), _list_item(right, i), similarity) for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    left = words.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    right = words.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "words_a", "words_b")
    return in_batches(joined).mapInArrow(check, "a binary, b binary")


def _alike(one: pa.StructArray, other: pa.StructArray, same: bool, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members of two blocks (places in one and in the other, equal signature bytes) that length, signature and parity let be links."""
    roots, numbers = {}, []
    for x in (one, other):
        numbers.append(np.array([roots.setdefault(r, len(roots)) for r in x.field(1).to_pylist()]))
    found = [(np.empty(0, np.int64),) * 3]
    if len(roots) == 1:
        return found[0]
    sizes_a, sizes_b = (x.field(2).to_numpy(zero_copy_only=False) for x in (one, other))
    signs_a, signs_b = (np.frombuffer(b"".join(x.field(3).to_pylist()), np.uint8).reshape(-1, SIGNS) for x in (one, other))
    bits_a, bits_b = (np.frombuffer(b"".join(x.field(5).to_pylist()), np.uint64).reshape(-1, PARITY // 64) for x in (one, other))
    enough, step = least_signs(similarity), max(1, 50_000 // len(other))
    for start in range(0, len(one), step):
        some = slice(start, start + step)
        longer = np.maximum(sizes_a[some, None], sizes_b[None, :])
        apart = np.abs(sizes_a[some, None] - sizes_b[None, :])
        fits = (numbers[0][some, None] != numbers[1][None, :]) & (apart <= (1 - similarity) * longer + 1e-9)
        if same:  # a block with itself: every pair once
            fits &= np.arange(len(one))[some, None] < np.arange(len(other))[None, :]
        i, j = np.nonzero(fits)
        agree = np.count_nonzero(signs_a[some][i] == signs_b[j], axis=1)
        i, j, agree = (x[agree >= enough] for x in (i, j, agree))
        edits = ((1 - similarity) * longer[i, j] + 1e-9).astype(np.int64)
        close = np.bitwise_count(bits_a[some][i] ^ bits_b[j]).sum(axis=1, dtype=np.int64) <= 2 * edits - apart[i, j]
        found.append((i[close] + start, j[close], agree[close]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _likeliest(at: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Of every member ``at`` the candidate with most equal signature bytes."""
    order = np.lexsort((-agree, at))
    return order[np.unique(at[order], return_index=True)[1]]


def block_pairs(held: DataFrame, nodes: DataFrame, similarity: float, nearest: bool = False) -> DataFrame:
    """Pairs (a, b) of members of a bucket in different classes that length, signature and parity do not rule out.

    ``held``: bucket, node, root; ``nodes``: node, n_words, signs, parity. A link has words apart for its edits only, two each at most, so
    parities with more bits apart are none. Members meet in blocks, so a pair of blocks is a row of a join and not a pair of texts.
    Lengths are cut into classes; a link is within a class or between neighbouring ones. All such pairs, each from the least
    bucket that holds both; but with ``nearest``, where two blocks have more than ``CROWD`` for each member, for every member the one with
    most equal signature bytes. ``crowded`` tells the latter pairs.
    """
    width = -float(np.log(similarity)) if 0 < similarity < 1 else None
    size = (F.floor(F.log(F.greatest(F.col("n_words"), F.lit(1))) / F.lit(width)) if width else F.lit(0)).cast("int").alias("size")
    # marks travel once with each node until its blocks are known
    placed = held.select("bucket", "node", "root").join(nodes.select("node", size), "node")
    counts = placed.groupBy("bucket", "size").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("n_blocks"))
    dealt = placed.join(counts, ["bucket", "size"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")))
    shared = dealt.groupBy("node", "root", "size").agg(F.collect_list(F.struct("bucket", "block")).alias("places"))
    shared = shared.join(nodes.select("node", "n_words", "signs", "parity"), "node").withColumn("buckets", F.col("places.bucket"))
    member = F.struct("node", "root", "n_words", "signs", "buckets", "parity")
    rows = shared.select(F.explode("places").alias("place"), "size", member.alias("member")).select("place.bucket", "size", "place.block", "member")
    blocks = materialize(rows.groupBy("bucket", "size", "block").agg(F.collect_list("member").alias("members")), "blocks")
    # a block meets those of its own length class and the next one
    reached = F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("size")
    left = blocks.select("bucket", reached, F.col("size").alias("size_a"), F.col("block").alias("block_a"), F.col("members").alias("left"))
    right = blocks.select("bucket", "size", F.col("block").alias("block_b"), F.col("members").alias("right"))
    # dealt by key: split further for their bytes, each part of a bucket would read all it meets again
    met = left.repartition("bucket", "size").join(right.repartition("bucket", "size"), ["bucket", "size"]).filter("size > size_a OR block_b >= block_a")
    met = met.selectExpr("left", "right", "bucket", "size = size_a AND block_a = block_b AS same")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one, other = (batch.column(c)[row].values for c in (0, 1))
                bucket, same = batch.column(2)[row].as_py(), batch.column(3)[row].as_py()
                i, j, agree = _alike(one, other, same, similarity)
                if not len(i):
                    continue
                crowded = nearest and len(i) > CROWD * (len(one) + len(other))
                if crowded:
                    chosen = np.union1d(_likeliest(i, agree), _likeliest(j, agree))
                else:
                    held_a, held_b = ({k: set(x.field(4)[k].as_py()) for k in set(at.tolist())} for x, at in ((one, i), (other, j)))
                    chosen = np.flatnonzero([min(held_a[k] & held_b[m]) == bucket for k, m in zip(i.tolist(), j.tolist(), strict=True)])
                names = [x.field(0).take(pa.array(at[chosen])) for x, at in ((one, i), (other, j))]
                for start in range(0, len(chosen), 10_000):
                    some = [x.slice(start, 10_000) for x in names]
                    yield pa.RecordBatch.from_arrays([*some, pa.repeat(pa.scalar(crowded), len(some[0]))], names=["a", "b", "crowded"])

    found = in_batches(met).mapInArrow(compare, "a binary, b binary, crowded boolean")
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    pairs = materialize(found.select(*ends, "crowded"), "pairs")
    discard(blocks)
    return pairs


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of every node in the links (a, b) of one task."""
    above: dict[bytes, bytes] = {}

    def top(node: bytes) -> bytes:
        while (up := above.setdefault(node, node)) != node:
            above[node] = above[up]
            node = up
        return node

    for batch in batches:
        for a, b in zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True):
            low, high = sorted((top(a), top(b)))
            above[high] = low
    names = list(above)
    if names:
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([top(n) for n in names], pa.binary())], names=["node", "root"])


def connected(links: DataFrame, few: bool = False) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): alternating star contraction until nothing changes; by one task if they are ``few``."""
    if few:
        return links.select("a", "b").filter("a <> b").repartition(1).mapInArrow(_contract, "node binary, root binary")
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    seen = None
    while True:
        # every node hands its larger neighbours to the least one it knows
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every node hands its smaller neighbours and itself to the least one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        edges = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")).first()
        # as many edges as nodes that are not least: every node has one edge; done once no root is below another
        if state[0] == state[2] and edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty() or state == seen:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in classes after the ``links`` (a, b) have joined the classes of ``labels``."""
    few = links.count() <= FEW_LINKS
    if labels is None:
        return materialize(connected(links, few), "labels")
    by_end = [labels.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")) for end in ("a", "b")]
    ends = links.join(by_end[0], "a", "left").join(by_end[1], "b", "left")
    ends = ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).filter("a <> b")
    moved = materialize(connected(ends, few), "moved")
    further = moved.select(F.col("node").alias("root"), F.col("root").alias("new_root"))
    known = labels.join(further, "root", "left").select("node", F.coalesce("new_root", "root").alias("root"))
    return materialize(known.unionByName(moved.join(labels.select("node"), "node", "left_anti")), "labels")


def text_classes(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, and (node, root) of the nodes that are not alone."""
    sketched = materialize(sketch_documents(docs, similarity), "sketches")
    once = [F.first(c).alias(c) for c in ("sketches", "n_words", "signs")]
    nodes = sketched.groupBy("node").agg(F.min("doc_id").alias("doc_id"), *once)
    nodes = materialize(nodes, "nodes")
    rows = materialize(sketched.select("doc_id", "node"), "rows")
    discard(sketched)
    placed = nodes.select("node", F.posexplode("sketches").alias("turn", "bucket")).withColumn("early", F.expr(f"turn % {SKETCHES} < {FIRST}")).drop("turn")
    filled = placed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n")).filter("low <> high")
    members = materialize(placed.join(filled.select("bucket", "n"), "bucket"), "members")
    # the original of many copies shares its buckets with most of them, a copy with few
    met = members.groupBy("node").agg(F.sum("n").alias("met"))
    members = materialize(members.select("bucket", "node", "early").join(met, "node"), "ranked")
    wanted = members.select("node").distinct().join(nodes, "node").select(F.col("node").alias("n"), "doc_id")
    texts = _texts(docs).withColumnRenamed("doc_id", "id")
    texts = texts.join(wanted, (F.col("node") == F.col("n")) & F.col("id").eqNullSafe(F.col("doc_id")))
    words = materialize(_words_of(texts.select("node", "text")), "words")

    labels = marks = None
    step, end = 0, STARS + NEAREST + 1  # the first sketches, stars, candidates in blocks, all that are left
    while step <= end:
        stars = step <= STARS
        classed = members.filter("early") if step == 0 else members
        if labels is None:
            classed = classed.withColumn("root", F.col("node"))
        else:
            classed = classed.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
        open_buckets = (
            classed.groupBy("bucket")
            .agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct(-F.col("met"), "node", "root")).alias("first"))
            .filter("low <> high")
            .select("bucket", "n", F.col("first.node").alias("centre"), F.col("first.root").alias("centre_root"))
        )
        held = materialize(classed.join(open_buckets, "bucket"), "open")
        if step > 0 and held.isEmpty():
            break
        few = F.lit(1 < step <= STARS) & (F.col("n") <= SMALL)
        if stars:
            pairs = held.filter("root <> centre_root").select(F.col("centre").alias("a"), F.col("node").alias("b"))
        else:
            if marks is None:  # later rounds hold some of these nodes
                marked = held.select("node").distinct().join(nodes.select("node", "n_words", "signs"), "node")
                marks = materialize(marked.join(words.select("node", "parity").dropDuplicates(["node"]), "node"), "marks")
            pairs = block_pairs(held, marks, similarity, nearest=step < end)
        if 1 < step <= STARS:
            little = held.filter(few)
            pairs = pairs.unionByName(
                little.select("bucket", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("met").alias("met_a"))
                .join(little.select("bucket", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("met").alias("met_b")), "bucket")
                .filter("(met_a > met_b OR (met_a = met_b AND a < b)) AND ra <> rb")  # the order in which members become centres
                .select("a", "b")
            )
        crowded = not stars and not pairs.filter("crowded").isEmpty()
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = materialize(verify(pairs, words, similarity), "links")
        labels = merged(labels, found)
        if not stars and not crowded:  # all candidates are compared
            break
        if stars and step > 0:  # what goes on: larger buckets without their centre
            members = held.filter(~few & (F.col("node") != F.col("centre"))).select("bucket", "node", "early", "met")
        if 1 < step <= STARS and found.count() < SETTLING * held.count():
            step = STARS
        elif not stars and found.isEmpty():  # a further round of likeliest candidates would compare the same ones
            step = end - 1
        step += 1
    return rows, labels


def duplicate_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, class_size (rows of the class), n_texts (different texts in it) of every row."""
    rows, roots = text_classes(docs, similarity)
    by_text = rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    by_text = by_text.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first_id", "copies")
    by_class = by_text.groupBy("root").agg(
        F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"), F.count("*").alias("n_texts")
    )
    named = by_text.select("node", "root").join(by_class, "root").drop("root")
    return rows.join(named, "node").select("doc_id", "class_id", "class_size", "n_texts")


def drop_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of every class, the one of least (id, text digest); all columns of ``docs`` stay."""
    rows, roots = text_classes(docs, similarity)
    by_text = rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    by_text = by_text.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = materialize(by_text.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "node")).alias("kept")), "kept")
    kept = kept.select(F.col("kept.first_id").alias("kept_id"), F.col("kept.node").alias("kept_node"))
    node = F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))
    found = docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]) & (node == kept["kept_node"]), "left_semi")
    once = rows.groupBy("doc_id", "node").count().filter("count > 1").isEmpty()
    return found if once else found.dropDuplicates(["doc_id", "text"])
