"""Exact n-gram Jaccard self-join by universe partition and the pigeonhole.

A document's set holds the hashes of its distinct word shingles (with fewer
words than a shingle, the whole sequence is one).  Two sets link when
``den * |A & B| >= num * |A | B|``.

Sizes are cut into bands so that linked sets lie in one band or in neighbours;
a band's scheme serves the sets of the band and of the one below.  Its largest
symmetric difference D gives the pigeonhole: the token universe is hashed into
segments with allocations v of 0, 1 or 2; when they add up to D + 1, linked sets
have a segment that differs in fewer than v tokens.  v = 1 indexes the segment's
token subset, v = 2 also its one-deletion neighbourhood (each subset without one
token), which meets sets that differ by one.  Segments with very few tokens
would match anything: they get v = 0 as long as a set's other segments still
add up to D + 1, for which schemes are given spare segments.  How many, and how
many with v = 2, is chosen per band by expected cost (index entries against
accidental matches) from the band's number of sets.

Sets with equal content are one node.  Nodes in one bucket are candidates, but
never all pairs of a bucket: first each node is verified against one node of
its buckets; then, within buckets that still hold several components, a parity
sketch (an exact upper bound of the overlap) leaves the pairs that can link, of
which a spanning forest is verified; at last every remaining pair across
components that the sketch allows is verified.  So no link that could join two
components is left out, and a large group of near copies costs about its size.

Scale: one exchange of texts (to the sets' first documents), then only
signatures, sketches and the candidates' sets move.  Large buckets are compared
in tiles (see ``buckets``), so no task holds a whole one.  The driver sees band
counts and loop counters only.

Defined results: null and empty texts have no set, link with nothing and are
their own component; a very long text is one set, held by one task; repeated rows
link like any equal texts; a null id counts as larger than all others (a
component of such rows only has a null id); ties have no effect, the smallest id
names a component; other columns, of whatever name, are not read; an empty table
gives no rows.  Shingles are compared by 64 bits of hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .buckets import dealt, forest, groups, pair_batches, sides, tiled
from .chunks import NULL_ID

#: Bits of the filter that spares texts outside all buckets an exchange (16 MB).
FILTER_BITS = 1 << 27
#: Tokens from which a segment counts, by allocation.
RICH = {1: 2, 2: 3}


class Rule:
    """Shingle length, similarity num / den, and the size bands that follow."""

    def __init__(self, words: int = 3, num: int = 90, den: int = 100):
        self.words, self.num, self.den = words, num, den

    def edges(self, largest: int) -> list[int]:
        """Last size of each band."""
        out = [1]
        while out[-1] < largest:
            out.append(max(out[-1] + 1, out[-1] * self.den // self.num))
        return out

    def difference(self, a, b):
        """Bound of the symmetric difference of linked sets of sizes up to a and b."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def linked(self, overlap, a, b):
        return self.den * overlap >= self.num * (a + b - overlap)


def _poisson_below(mean: float, k: int) -> float:
    term, total = math.exp(-mean), 0.0
    for i in range(k):
        total += term
        term *= mean / (i + 1)
    return min(1.0, total)


def allocation(sets: int, cases: list[tuple[int, int]], d: int) -> tuple[int, int]:
    """(segments with v = 1, segments with v = 2) of least expected cost for
    ``sets`` sets and difference ``d``; cases: sizes of sets that must do, each
    with the difference that sets of this size can have."""
    best = (math.inf, (d + 1, 0))
    for spare in sorted({d * k // 40 + k // 4 for k in range(0, 41)}):
        total = d + 1 + spare
        for two in {0, total // 4, total // 2}:
            one = total - 2 * two
            cost = one + two * (1 + cases[0][0] / (one + two))
            for size, own in cases:
                mean = size / (one + two)
                poor = one * _poisson_below(mean, RICH[1]) + 2 * two * _poisson_below(mean, RICH[2])
                short = 1 - _poisson_below(poor, total - own) if poor < 700 else 1.0
                cost += sets * short * short * (one + two) * math.exp(-mean) / len(cases)
            best = min(best, (cost, (one, two)))
    return best[1]


def sets_of(col: pa.LargeStringArray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts, sorted within each, and offsets."""
    w = C.Words(col, C.SPACE_WORD, True)
    h = w.hashes()
    at, doc = w.windows(words)
    x = C.window_hash(h, at, words)
    few = np.flatnonzero((w.counts > 0) & (w.counts < words))
    for size in np.unique(w.counts[few]).tolist():
        own = few[w.counts[few] == size]
        x = np.concatenate((x, C.window_hash(h, w.first[own], size)))
        doc = np.concatenate((doc, own))
    order = np.lexsort((x, doc))
    x, doc = x[order], doc[order]
    b = C.bounds(np.column_stack([x, doc.astype(C.U64)]))
    x, doc = x[b], doc[b]
    return x, np.searchsorted(doc, np.arange(len(col) + 1))


def digests(docs: DataFrame, rule: Rule) -> DataFrame:
    """(id, th, n, h1, h2): text hash, size and 128-bit hash of every row's set."""

    def rows(batches):
        for b, col in C.batches_of(batches, "text"):
            x, off = sets_of(col, rule.words)
            zero = np.zeros(1, C.U64)
            pre = [np.concatenate((zero, np.cumsum(C.mix(x ^ C.U64(s)), dtype=C.U64))) for s in (0x51, 0xA7)]
            h = [(p[off[1:]] - p[off[:-1]]).view(np.int64) for p in pre]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.array(np.diff(off).astype(np.int64)),
                                              *map(pa.array, h)], ["id", "th", "n", "h1", "h2"])

    return docs.select("id", "th", "text").mapInArrow(rows, "id long, th long, n long, h1 long, h2 long")


class _Schemes:
    """Segments of every band, and the signatures of sets under them."""

    def __init__(self, rule: Rule, counts: list[tuple[int, int]]):
        """counts: (size, number of sets), any grouping of sizes."""
        self.edges = np.array(rule.edges(max([n for n, _ in counts], default=1)) + [0])
        self.edges[-1] = max(self.edges[-2] + 1, self.edges[-2] * rule.den // rule.num)
        per = np.bincount(np.searchsorted(self.edges, [n for n, _ in counts]), [c for _, c in counts], len(self.edges))
        k = len(self.edges)
        self.d, self.one, self.two = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for i in range(k):
            self.d[i] = rule.difference(int(self.edges[i]), int(self.edges[i]))
            if self.d[i] > 0:
                top = int(self.edges[i])
                sizes = (top, int(self.edges[i - 1]) + 1, int(self.edges[i - 2]) + 1 if i > 1 else 1)
                cases = [(n, rule.difference(n, min(top, n * rule.den // rule.num))) for n in sizes]
                self.one[i], self.two[i] = allocation(int(per[i] + per[i - 1]), cases, int(self.d[i]))
        self.rule = rule

    def signatures(self, x: np.ndarray, off: np.ndarray):
        """(signature, set, role) of the sets' index entries; role: 1 own band, 2 whole subset."""
        size = np.diff(off)
        band = np.searchsorted(self.edges, size)
        out = [[], [], []]
        for guest in (0, 1):
            scheme = np.minimum(band + guest, len(self.edges) - 1)
            use = np.flatnonzero((size > 0) & (self.d[scheme] > 0) & (band + guest < len(self.edges)))
            if not len(use):
                continue
            k = scheme[use]
            m = self.one[k] + self.two[k]
            base = np.cumsum(m) - m
            token = np.concatenate([np.arange(a, b) for a, b in zip(off[use], off[use + 1])])
            of = np.repeat(np.arange(len(use)), size[use])
            code = C.mix(x[token] + C.U64(0x9E3779B97F4A7C15) * (k[of] + 1).astype(C.U64))
            seg = ((code >> C.U64(33)) % m[of].astype(C.U64)).astype(np.int64) + base[of]
            code = C.mix(code)
            total = np.zeros(int(m.sum()), C.U64)
            np.add.at(total, seg, code)
            count = np.bincount(seg, minlength=len(total))
            owner = np.repeat(np.arange(len(use)), m)
            place = np.arange(len(total)) - base[owner]
            two = place >= self.one[k][owner]
            v = 1 + two
            rich = count >= np.where(two, RICH[2], RICH[1])
            # the difference that a set of this size can have under the scheme
            own = self.rule.difference(size[use], np.minimum(self.edges[k], size[use] * self.rule.den // self.rule.num))
            enough = np.bincount(owner, v * rich, len(use)) >= own + 1
            kept = (count >= 2) | ~enough[owner]
            salt = C.mix((k[owner].astype(C.U64) << C.U64(32)) + place.astype(C.U64))
            whole = np.flatnonzero(kept)
            less = np.flatnonzero(kept[seg] & two[seg])
            out[0] += [C.mix(total[whole] ^ salt[whole]), C.mix((total[seg[less]] - code[less]) ^ salt[seg[less]])]
            out[1] += [use[owner[whole]], use[of[less]]]
            role = 0 if guest else 1
            out[2] += [np.full(len(whole), role + 2, np.int8), np.full(len(less), role, np.int8)]
        kinds = (C.U64, np.int64, np.int8)
        return [np.concatenate(o) if o else np.zeros(0, t) for o, t in zip(out, kinds)]


def _texts(keyed: DataFrame, lead: DataFrame) -> DataFrame:
    """(node, text): one text of each node in ``lead(id, th, node)``."""
    # repeated rows: equal (id, th), the key of the join's exchange
    return (keyed.join(lead.hint("merge"), ["id", "th"]).dropDuplicates(["id", "th"]).select("node", "text"))


def _index(nodes: DataFrame, schemes: _Schemes, rule: Rule) -> DataFrame:
    """(sig, node, center) of all buckets with two nodes or more; center: the
    bucket's smallest node."""

    def rows(batches):
        for b, col in C.batches_of(batches, "text", C.SLICE_BYTES // 2):
            sig, at, role = schemes.signatures(*sets_of(col, rule.words))
            node = b.column("node").to_numpy()[at]
            yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(node * 4 + role)], ["sig", "entry"])

    sig = Window.partitionBy("sig")
    # an entry is the node and, in its two low bits, the role
    entries = nodes.select("node", "text").mapInArrow(rows, "sig long, entry long")
    node, role = F.shiftright("entry", 2), F.col("entry").bitwiseAND(F.lit(3))
    return (entries.select("sig", node.alias("node"), F.min(node).over(sig).alias("center"), F.max(node).over(sig).alias("top"),
                           F.max(role % 2).over(sig).alias("own"), F.max(role >= 2).over(sig).alias("whole"))
            .where("center < top and own = 1 and whole").select("sig", "node", "center").distinct())


def _sketch(x: np.ndarray, width: int) -> np.ndarray:
    """Parity of the tokens on each of ``width`` bits (a power of two)."""
    hit = np.bincount((C.mix(x) >> C.U64(20) & C.U64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(hit.astype(np.uint8), bitorder="little")


def candidates(keyed: DataFrame, lead: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """(node, n, tokens, sketch) of the nodes in ``members``."""

    def rows(batches):
        for b, col in C.batches_of(batches, "text"):
            x, off = sets_of(col, rule.words)
            own = [x[s:e] for s, e in zip(off[:-1], off[1:])]
            width = [1 << max(8, int(32 * rule.difference(len(s), len(s))).bit_length()) for s in own]
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array([len(s) for s in own], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(x.view(np.int64))),
                 pa.array([_sketch(s, w).tobytes() for s, w in zip(own, width)], pa.binary())],
                ["node", "n", "tokens", "sketch"])

    wanted = C.saved(lead.join(members.select("node").distinct(), "node", "left_semi"), "jaccard-wanted")
    # a bitmap of fixed size keeps most other texts from moving; the join decides
    place = F.pmod(F.xxhash64("id", "th"), F.lit(FILTER_BITS)) + 1
    parts = (wanted.groupBy(F.bitmap_bucket_number(place).alias("k"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect())
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts:  # of 4 kB each
        bits[(r["k"] - 1) * 4096:r["k"] * 4096] = np.frombuffer(r["bits"], np.uint8)

    def likely(batches):
        for b in batches:
            p = b.column("place").to_numpy() - 1
            yield b.select(["id", "th", "text"]).filter(pa.array((bits[p >> 3] >> (p & 7) & 1).astype(bool)))

    some = keyed.select("id", "th", "text", place.alias("place")).mapInArrow(likely, "id long, th long, text string")
    return C.saved(_texts(some, wanted).mapInArrow(rows, "node long, n long, tokens array<long>, sketch binary"), "jaccard-sets")


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    pairs = C.saved(pairs, "jaccard-pairs")  # a known size: few pairs need no exchange of the sets

    def side(end: str) -> DataFrame:
        return pairs.join(sets.select(F.col("node").alias(end), F.col("tokens").alias(f"t{end}")), end)

    overlap = F.size(F.array_intersect("ta", "tb"))
    both = side("a").join(side("b"), ["a", "b"]).select("a", "b", overlap.alias("o"), F.size("ta").alias("na"), F.size("tb").alias("nb"))
    return both.where(rule.linked(F.col("o"), F.col("na"), F.col("nb"))).select("a", "b")


def _fold(sketch: bytes, width: int) -> np.ndarray:
    s = np.frombuffer(sketch, C.U64)
    while len(s) > width:
        s = s[:len(s) // 2] ^ s[len(s) // 2:]
    return s


def _possible(sketches: list, sizes: np.ndarray, rule: Rule, rows: np.ndarray, cols: np.ndarray):
    """Pairs of rows x cols that may link, with the bound of their difference."""
    width = min(len(s) for s in sketches) // 8
    s = np.array([_fold(x, width) for x in sketches])
    out = [[], [], []]
    for i in range(0, len(rows), 64):
        r = rows[i:i + 64]
        least = np.zeros((len(r), len(cols)), np.int64)
        for w in range(width):
            least += np.bitwise_count(s[r, w][:, None] ^ s[cols, w][None, :])
        total = sizes[r][:, None] + sizes[cols][None, :]
        overlap = np.minimum((total - least) // 2, np.minimum(sizes[r][:, None], sizes[cols][None, :]))
        p, q = np.nonzero(rule.linked(overlap, sizes[r][:, None], sizes[cols][None, :]))
        for o, v in zip(out, (r[p], cols[q], least[p, q])):
            o.append(v)
    return [np.concatenate(o) for o in out]


def across(members: DataFrame, sets: DataFrame, comp: DataFrame, rule: Rule, spanning: bool, spare: int | None = None) -> DataFrame:
    """Pairs (a, b) of one bucket, in different components, that may link: all,
    or a spanning forest of the components of each tile (closest first).

    With ``spare``, a tile of which there are at most ``spare`` pairs a row gives
    all of them, and (a, b, open) come back: besides the pairs, a row with null
    ends names every bucket ``open`` of which not all pairs were given."""
    rows = dealt(tiled(members.select("sig", "node"), comp, ()).join(sets.select("node", "n", "sketch"), "node"))

    def compare(t: pa.Table):
        node, comp_, n = (t.column(c).to_numpy() for c in ("node", "comp", "n"))
        sketches = [x.as_buffer() for c in t.column("sketch").chunks for x in c]
        first, second, same = sides(t)
        if not len(first) or not len(second):
            return
        p, q, least = _possible(sketches, n, rule, first, second)
        ok = comp_[p] != comp_[q]
        if same:
            ok &= p < q
        p, q, least = p[ok], q[ok], least[ok]
        every = len(p)
        if spanning and (spare is None or every > spare * t.num_rows):
            chosen = forest(comp_[p], comp_[q], least)
            p, q = p[chosen], q[chosen]
        for b in pair_batches(node[p], node[q]):
            yield b if spare is None else b.append_column("open", pa.nulls(b.num_rows, pa.int64()))
        if spare is not None and len(p) < every:
            yield pa.RecordBatch.from_pydict({"a": pa.nulls(1, pa.int64()), "b": pa.nulls(1, pa.int64()),
                                              "open": pa.array([t.column("sig")[0].as_py()], pa.int64())})

    rows = rows.select("sig", "ti", "tj", "side", "node", "comp", "n", "sketch")
    schema = "a long, b long" if spare is None else "a long, b long, open long"
    return rows.mapInArrow(lambda batches: groups(batches, ("sig", "ti", "tj"), compare), schema).distinct()


def classes(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """(id, th, n, lead_id, lead_th) of every row of ``docs(doc_id, text)``:
    text hash, set size, and the smallest (id, text hash) it is linked with,
    directly or through others."""
    rule = rule or Rule()
    keyed = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.xxhash64("text").alias("th"), "text")
    digest = C.saved(digests(keyed, rule), "jaccard-digests")
    nodes = C.saved(digest.where("n > 0").groupBy("h1", "h2", "n").agg(F.min(F.struct("id", "th")).alias("lead"))
                    .withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")
    # sizes in steps of 2 %: a bounded number of counts
    step = F.floor(F.log(F.col("n").cast("double")) * 50)
    counts = [(r["m"], r["c"]) for r in nodes.groupBy(step).agg(F.max("n").alias("m"), F.count(F.lit(1)).alias("c")).collect()]
    schemes = _Schemes(rule, counts)

    lead = nodes.select("node", F.col("lead.id").alias("id"), F.col("lead.th").alias("th"))
    members = C.saved(_index(_texts(keyed, lead), schemes, rule), "jaccard-buckets")
    sets = candidates(keyed, lead, members, rule)

    first = members.groupBy("node").agg(F.min("center").alias("b")).select(F.col("node").alias("a"), "b").where("a != b")
    links = C.saved(verified(first, sets, rule), "jaccard-links")
    comp = C.components(links)
    for spanning in (True, True, False):
        more = C.saved(verified(across(members, sets, comp, rule, spanning), sets, rule), "jaccard-links")
        if not more.isEmpty():
            comp = C.components(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(more))

    of = nodes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    leads = of.groupBy("comp").agg(F.min("lead").alias("top"))
    found = of.join(leads, "comp").select("h1", "h2", "n", "top")
    out = digest.join(found, ["h1", "h2", "n"], "left")
    return out.select("id", "th", "n", F.coalesce(F.col("top.id"), "id").alias("lead_id"),
                      F.coalesce(F.col("top.th"), "th").alias("lead_th"))


def id_of(col: str):
    return F.when(F.col(col) != NULL_ID, F.col(col))


def report(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: n_shingles, component_id."""
    return classes(docs, rule).select(id_of("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                      id_of("lead_id").alias("component_id"))


def keep_one(docs: DataFrame, rule: Rule, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each class, all its columns as they were: the one
    with the smallest id (then text hash).  Rows without words all stay."""
    own = C.plain(docs, id_col, text_col)
    lead = (classes(own, rule).where("n > 0 and id = lead_id and th = lead_th")
            .select(F.col("id").alias("_k_id"), F.col("th").alias("_k_th")).distinct().hint("merge"))
    key, th = "_k_id", "_k_th"
    names = [f"_c{i}" for i in range(len(docs.columns))]
    keyed = docs.toDF(*names)
    text = F.col(names[docs.columns.index(text_col)])
    keyed = keyed.select("*", F.coalesce(F.col(names[docs.columns.index(id_col)]).cast("long"), F.lit(NULL_ID)).alias(key),
                         F.xxhash64(text).alias(th))
    wordy = F.coalesce(F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")) > 0, F.lit(False))
    kept = keyed.where(wordy).join(lead, [key, th], "left_semi").dropDuplicates([key, th])
    return kept.select(*names).union(keyed.where(~wordy).select(*names)).toDF(*docs.columns)
