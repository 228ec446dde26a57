"""N-gram Jaccard join with set-relation skipping.

Two sets x, y with n(x) + n(y) elements and d differing ones have a Jaccard similarity of at least
p percent if and only if (100 + p) * d <= (100 - p) * (n(x) + n(y)).

Block-skip index. Sets are cut by size into classes whose bounds grow by 100 / p, so partners lie in
the same or neighbouring classes. For a pair of classes with at most H differences the hash space is cut
into H + 1 + q blocks. At most H of them differ, so with at most q empty blocks one filled block is
equal, and an index list per (classes, block, content of the block) finds the pair, while all lists of
other contents are skipped.

Answers from a similar set. Sets that share lists, directly or through others, form a group with a
leader, the first set of the lists that its members share most. Members are near (they link with
the leader), between (a set near the leader may link with both) or remote. For near and between
members the differences D(x) from the leader are kept, and the answers follow from them, without looking
at the texts again: d(x, y) = |D(x)| + |D(y)| - 2 |D(x) & D(y)|. Near members are one component by the
leader. If x does not link with the leader, x and a near y need common differences: with none,
d = |D(x)| + |D(y)|, and as y has at most |D(y)| elements more than the leader, x would link with the
leader too. Two sets between are compared in the same way; remote sets, with each other and
with those between, too, but by their differences from the empty set. How many common differences are needed at least follows from the sizes, so a prefix of
D(x), rare elements first, is enough to find y, and the positions inside the
prefix skip most of the rest. Copies of one text with edits of their own share hardly any
differences, so a group of any size makes few pairs.

A group may hold many such families besides its leader's. So members that are not near are clustered by the
lists they share, and those of one cluster meet by their differences from its core, what most of
them have, instead; by the other differences only members of different clusters do.
"""

import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.common import discard, shuffles_released, sliced, small_batches, stored
from rillflow.llm.components import components
from rillflow.llm.packed import expand, squeeze
from rillflow.llm.shingles import mix, shingle_set


BUCKET = 500_000  # index entries of a bucket, about
SLICE = 500_000  # entries dealt to buckets at a time
FEW = 8  # members of a cluster that need no core, as they make few pairs
PARITIES = 512  # bits of a set that rule out pairs with too many differences
TRIED = 32  # members of a cluster whose elements are counted for its core
#: Bits of a key kept inside its bucket. A bucket has as many entries at every size of the input, so
#: unlike contents meet in a list as rarely; they would only make a group larger, not link.
KEPT = np.uint64(2**40 - 1)


def _most_differing(total: int, percent: int) -> int:
    return (100 - percent) * total // (100 + percent)


def _bounds(n: int, percent: int) -> list[int]:
    """Lower bounds of the size classes up to the one above n."""
    out = [1]
    while out[-1] <= n:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // percent)))
    return [*out, max(out[-1] + 1, -(-out[-1] * 100 // percent))]


def index_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """The keys of a set's index lists; sets that link share one, unless they are equal."""
    n = len(s)
    if not n:
        return np.zeros(0, dtype=np.int64)
    bounds = _bounds(n, percent)
    own = len(bounds) - 3  # bounds[own] <= n < bounds[own + 1]
    content, keys = mix(s ^ np.uint64(99)), []
    for lower in range(max(0, own - 1), own + 1):  # partners in the class below; in its own, above
        most = _most_differing(bounds[lower + 1] - 1 + bounds[lower + 2] - 1, percent)
        if not most:
            continue
        spare, level = 1 + most // 200, 0
        while True:
            blocks = most + 1 + spare
            block = s % np.uint64(blocks)
            order = np.argsort(block, kind="stable")
            at = block[order]
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            total = np.add.reduceat(content[order], first)
            tag = np.uint64(lower * 64 + level)
            keys.append(mix(mix(total + at[first]) * np.uint64(31) + at[first] + (tag << np.uint64(32))))
            if blocks - len(first) <= spare:
                break
            spare, level = 2 * spare + 1, level + 1
    return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, dtype=np.int64)


def _key_count(n: int, percent: int) -> int:
    """How many keys a set of n elements has at most on the first level, to size the buckets."""
    if not n:
        return 0
    bounds = _bounds(n, percent)
    own = len(bounds) - 3
    most = [_most_differing(bounds[i + 1] + bounds[i + 2] - 2, percent) for i in range(max(0, own - 1), own + 1)]
    return sum(min(n, m + 2 + m // 200) for m in most if m)


def _sets(size: int, percent: int):
    def run(batches):
        for batch in sliced(batches):
            n, sig = [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, size)
                n.append(len(s))
                sig.append(xxhash.xxh128_digest(s.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sig, pa.binary()),
                 pa.array([_key_count(k, percent) for k in n], pa.int64()), batch.column("text")],
                ["doc_id", "n", "sig", "n_keys", "text"])
    return run


def _deal(size: int, percent: int, buckets: int):
    """The (key, id) entries of the index, dealt to buckets of keys and packed."""
    def dealt(ids, lists):
        keys, x = np.concatenate(lists), np.repeat(np.array(ids, dtype=np.int64), [len(k) for k in lists])
        to = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        order = np.lexsort((x, to))
        keys, x = keys[order] & KEPT, x[order]
        cuts = np.searchsorted(to[order], np.arange(buckets + 1))
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        blobs = [squeeze(x[i:i + 1].view(np.uint64), np.diff(x[i:j]), keys[i:j]) for i, j in zip(cuts[full], cuts[full + 1])]
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "entries"])

    def run(batches):
        ids, lists, held = [], [], 0
        for batch in sliced(batches):
            for x, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                keys = index_keys(shingle_set(text, size), percent).view(np.uint64)
                if len(keys):
                    ids.append(x)
                    lists.append(keys)
                    held += len(keys)
                if held >= SLICE:
                    yield dealt(ids, lists)
                    ids, lists, held = [], [], 0
        if held:
            yield dealt(ids, lists)
    return run


def _lists(pdf: pd.DataFrame) -> pd.DataFrame:
    """The index lists of a bucket with two sets or more: each member with the first one. A list
    has a class once, out of the many keys of its set, so none is a large part of the entries."""
    parts = [expand(e) for e in pdf["entries"]]
    keys = np.concatenate([p[2].astype(np.uint64) for p in parts])
    x = np.concatenate([np.cumsum(np.concatenate([p[0].astype(np.uint64).view(np.int64), p[1].astype(np.int64)]))
                        for p in parts])
    order = np.lexsort((x, keys))
    keys, x = keys[order], x[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    many = np.diff(np.append(start, len(keys)))
    first = np.repeat(x[start], many)
    shared = np.repeat(many > 1, many)
    out = pd.DataFrame({"x": x[shared], "first": first[shared]})
    return out.groupby(["x", "first"]).size().reset_index(name="many").astype("int64")


FORMS = ("g long, x long, lead long, n long, bits array<long>, near boolean, delta array<long>, d_prefix int, "
         "own array<long>, o_prefix int")


def _parities(s: np.ndarray) -> np.ndarray:
    """A bit for each of `PARITIES` cells that elements fall into: whether their number is odd. An element
    that one of two sets has flips one bit, so their bits differ at most as often as the sets do."""
    cell = (mix(s ^ np.uint64(7)) % np.uint64(PARITIES)).astype(np.int64)
    return np.packbits(np.bincount(cell, minlength=PARITIES) & 1).view(np.int64)


def _differences(size: int, percent: int):
    """Each member's differences from its leader (near and between) and from the empty set (between
    and remote), each with the length of the prefix that partners meet in; see the module."""
    c = (100 - percent) / (100 + percent)

    def prefix(many, need):
        return max(0, many - max(math.ceil(need - 1e-6), 1) + 1)

    def forms(s, lead):
        n, k, bits = len(s), len(lead), _parities(s)
        new, gone = np.setdiff1d(s, lead, assume_unique=True), np.setdiff1d(lead, s, assume_unique=True)
        d = len(new) + len(gone)
        near = (100 + percent) * d <= (100 - percent) * (n + k)
        middle = min(n, k) * 100 // percent  # the largest set that links with both
        delta = np.concatenate([new, gone]).view(np.int64)
        if near:
            return n, bits, True, delta, prefix(d, (d - c * (n - k)) / 2), None, 0
        common = np.intersect1d(s, lead, assume_unique=True)  # as passages of many members are, so they come last
        own = np.concatenate([new, common]).view(np.int64), prefix(n, n * percent / 100)
        if (100 + percent) * d <= (100 - percent) * (n + k + 2 * middle):
            return n, bits, False, delta, prefix(d, (d - c * (n + k)) / (1 + c)), *own
        return n, bits, False, None, 0, *own

    def run(batches):
        held, lead = None, None
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int64()), pa.int32())
        for batch in sliced(batches):
            out = []
            for text, other in zip(batch.column("text").to_pylist(), batch.column("lead_text").to_pylist()):
                if lead is None or other != held:
                    held, lead = other, shingle_set(other, size)
                out.append(forms(shingle_set(text, size), lead))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("g"), batch.column("x"), batch.column("lead"),
                     *[pa.array(v, k) for v, k in zip(zip(*out), kinds)]],
                    [f.split()[0] for f in FORMS.split(", ")])
    return run


def jaccard_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable over links, two sets of `size`-word shingles
    linking at a Jaccard similarity of `percent` or more. Equal sets are one class from the start.
    Null and blank texts have the empty set and link with nothing. Rows that repeat an id are
    one node of the graph whose set is that of the id's first text in binary order; null ids keep
    n_shingles and get a null component. Shingles are compared by 64-bit hashes.
    """
    small_batches(docs.sparkSession)
    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # a table in buckets of ids, so that finding class representatives and members does not move texts
    name, spread = f"sets_{uuid.uuid4().hex}", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = parts.mapInArrow(_sets(size, percent), "doc_id long, n long, sig binary, n_keys long, text string")
    with shuffles_released(docs.sparkSession):
        sets.write.option("compression", "zstd").bucketBy(spread, "doc_id").saveAsTable(name)
    seen = docs.sparkSession.table(name)
    filled = seen.where("n > 0 and doc_id is not null")
    classes = filled.groupBy("sig").agg(F.min("doc_id").alias("rep"))
    same = filled.select("doc_id", "sig").join(classes, "sig").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    one = classes.select(F.col("rep").alias("doc_id"), F.col("sig").alias("rep_sig"))
    # classes and members grow with the corpus, so their joins are merge joins at every size
    reps = filled.join(one.hint("merge"), "doc_id").where(
        "sig >= rep_sig and sig <= rep_sig")  # as a join key it would undo the buckets
    buckets = max(1, (filled.agg(F.sum("n_keys")).first()[0] or 0) // BUCKET)
    sent = reps.select("doc_id", "text").mapInArrow(_deal(size, percent, buckets), "bucket int, entries binary")
    member = stored(sent.groupBy("bucket").applyInPandas(_lists, "x long, first long, many long"), "lists")
    groups = components(member.select(F.col("x").alias("a"), F.col("first").alias("b")))
    groups = stored(groups.select(F.col("id").alias("x"), F.col("component").alias("g")), "groups")
    weight = member.where("x != first").groupBy(F.col("first").alias("x")).agg(F.sum("many").alias("many"))
    leads = (groups.join(weight, "x").groupBy("g")
             .agg(F.max(F.struct("many", (-F.col("x")).alias("neg"))).alias("top"))
             .select("g", (-F.col("top.neg")).alias("lead")))
    whole = seen.select("doc_id", "text")
    whole = whole.groupBy("doc_id").agg(F.min("text").alias("text")) if _repeats(seen) else whole
    members = groups.hint("merge").join(whole, groups.x == whole.doc_id).select("g", "x", "text")
    lead_text = leads.hint("merge").join(whole, leads.lead == whole.doc_id).select(
        "g", "lead", F.col("text").alias("lead_text"))
    state = stored(members.join(lead_text, "g").mapInArrow(_differences(size, percent), FORMS), "differences")
    discard(groups)
    near = state.where("near").select(F.col("x").alias("a"), F.col("lead").alias("b"))
    derived, used = _derived(state, member, percent)
    found = components(same.unionByName(near).unionByName(derived))
    discard(state, member, *used)
    out = seen.select("doc_id", "n").join(found, F.col("doc_id") == F.col("id"), "left")
    out = stored(out.select("doc_id", F.col("n").alias("n_shingles"),
                            F.coalesce("component", "doc_id").alias("component_id")), "components")
    docs.sparkSession.sql(f"DROP TABLE {name}")
    return out


def _repeats(seen: DataFrame) -> bool:
    return bool(seen.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count())


def _clusters(state: DataFrame, member: DataFrame) -> DataFrame:
    """(x, cl): members that are not near in clusters of more than `FEW`, by the set that each shares most
    lists with. Members of a group may have many passages, those of a cluster mostly have the same."""
    far = state.where("not near").select("x")
    top = (member.where("x != first and many > 1").join(far, "x").join(far.select(F.col("x").alias("first")), "first")
           .groupBy("x").agg(F.max(F.struct("many", (-F.col("first")).alias("neg"))).alias("top"))
           .select(F.col("x").alias("a"), (-F.col("top.neg")).alias("b")))
    found = stored(components(top).select(F.col("id").alias("x"), F.col("component").alias("cl")), "clusters")
    large = found.groupBy("cl").count().where(F.col("count") > FEW).select("cl")
    out = found.join(large, "cl")
    out.read_from = found
    return out


def _from_cores(state: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Each member of a cluster by its differences from the cluster's core, a table.

    The core is what more than half of up to `TRIED` members have; it only decides how long the differences are. Let
    f(x) = (100 + p) |D(x)| - (100 - p) n(x). Two sets without a common difference link if and only if
    f(x) + f(y) <= 0, so then both link with the set of the least f, the head. Members are near if that
    holds for them and the head; all pairs of which one is not near need common differences, (100 + p)
    times twice their number is f(x) + f(y) at least.
    """
    own = state.where("not near").select("x", "n", "own").join(clusters, "x")
    ranked = Window.partitionBy("cl").orderBy(F.xxhash64("x"), "x")
    tried = clusters.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= TRIED).select("cl", "x")
    most = tried.groupBy("cl").agg((F.count("*") / 2).alias("half"))
    cores = (tried.join(state.select("x", "own"), "x").select("cl", F.explode("own").alias("e"))
             .groupBy("cl", "e").count().join(most, "cl").where(F.col("count") > F.col("half"))
             .groupBy("cl").agg(F.sort_array(F.collect_list("e")).alias("core")))

    def delta(own: pd.Series, core: pd.Series) -> pd.Series:
        out = []
        for s, r in zip(own, core):
            r = np.zeros(0, np.int64) if r is None else r
            out.append(np.concatenate([np.setdiff1d(s, r, assume_unique=True), np.setdiff1d(r, s, assume_unique=True)]))
        return pd.Series(out)

    differences = F.pandas_udf(delta, "array<long>")
    rows = own.join(cores, "cl", "left").select("cl", "x", "n", differences("own", "core").alias("d"))
    rows = stored(rows.withColumn("f", (100 + percent) * F.size("d") - (100 - percent) * F.col("n")), "from-cores")
    heads = rows.groupBy("cl").agg(F.min(F.struct("f", "x")).alias("head")).select(
        "cl", F.col("head.x").alias("head"), F.col("head.f").alias("least"))
    twice = 2.0 * (100 + percent)
    near = F.col("f") + F.col("least") <= 0
    need = F.greatest(F.lit(1), F.ceil(F.when(near, F.col("f") - F.col("least")).otherwise(F.col("f") + F.col("least")) / twice - 1e-6))
    out = rows.join(heads, "cl").select(
        "cl", "x", "n", "d", "head", near.alias("near"),
        F.greatest(F.lit(0), F.size("d") - need + 1).cast("int").alias("prefix"))
    out.read_from = rows
    return out


def _deal_elements(buckets: int):
    """The elements of sets with their owners, dealt to buckets of elements and packed."""
    def dealt(rows):
        x, c, sets = zip(*((x, c, mix(s.view(np.uint64) ^ mix(np.array([g]).view(np.uint64)))) for g, x, c, s in rows))
        keys, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        to = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(to, kind="stable")
        keys, owner, cuts = keys[order] & KEPT, owner[order], np.searchsorted(to[order], np.arange(buckets + 1))
        full, out = np.flatnonzero(cuts[1:] > cuts[:-1]), []
        x, c = np.array(x, np.int64).view(np.uint64), np.array(c, np.int64).view(np.uint64)
        for i, j in zip(cuts[full], cuts[full + 1]):
            own, many = np.unique(owner[i:j], return_counts=True)
            out.append(squeeze(x[own], c[own], many, keys[i:j]))
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(out, pa.binary())], ["bucket", "entries"])

    def run(batches):
        rows, held = [], 0
        for batch in sliced(batches):
            sets = batch.column("s")
            for i, (g, x, c) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("g", "x", "c")))):
                rows.append((g, x, c, np.array(sets[i].values.to_numpy(zero_copy_only=False))))
                held += len(rows[-1][3])
                if held >= SLICE:
                    yield dealt(rows)
                    rows, held = [], 0
        if held:
            yield dealt(rows)
    return run


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """The elements of a bucket that several sets have, for each of these: `mixed` if their c differ,
    and `kinds`, by which elements are ordered: the number of the sets, 1 if they have one c."""
    parts = [[a.astype(np.uint64) for a in expand(e)] for e in pdf["entries"]]
    keys = np.concatenate([p[3] for p in parts])
    x, c = (np.concatenate([np.repeat(p[k], p[2].astype(np.int64)) for p in parts]).view(np.int64) for k in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, x, c = keys[order], x[order], c[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    many = np.diff(np.append(start, len(keys)))
    mixed = np.minimum.reduceat(c, start) < np.maximum.reduceat(c, start)
    more = np.repeat(many > 1, many)
    e = keys.view(np.int64) | np.int64(int(pdf["bucket"].iloc[0]) << 40)
    return pd.DataFrame({"x": x, "e": e, "kinds": np.repeat(np.where(mixed, many, 1), many),
                         "mixed": np.repeat(mixed, many)})[more]


def _rarest(rows: DataFrame) -> DataFrame:
    """(g, x, c, n, asks, far, i, e) of rows (g, x, c, n, asks, s, prefix): the places i in the prefixes of the
    sets s that hold elements of members with another c. Elements are ordered by how many members of the
    group have them, those of one member first, those of one c next. Passages that members share, unlike their
    leader, would be in most of their prefixes otherwise. All members of a group have one order, and any
    order gives the same links, so the counts only decide how many rows meet. What no other member has
    only takes places in front, so neither it nor the set travels again.
    """
    buckets = max(1, (rows.agg(F.sum(F.size("s"))).first()[0] or 0) // BUCKET)
    sent = rows.select("g", "x", "c", "s").mapInArrow(_deal_elements(buckets), "bucket int, entries binary")
    shared = (sent.groupBy("bucket").applyInPandas(_shared, "x long, e long, kinds long, mixed boolean")
              .groupBy("x").agg(F.array_sort(F.collect_list(F.struct("kinds", "e", "mixed"))).alias("shared")))
    placed = rows.select("g", "x", "c", "n", "asks", F.size("s").alias("far"), "prefix").join(shared, "x").select(
        "g", "x", "c", "n", "asks", "far", "prefix", (F.col("far") - F.size("shared")).alias("alone"),
        F.posexplode("shared").alias("at", "one"))
    return placed.withColumn("i", F.col("alone") + F.col("at")).where("one.mixed and i < prefix").select(
        "g", "x", "c", "n", "asks", "far", "i", "one.e")


def _fronts(state: DataFrame) -> DataFrame:
    """The places in which members can meet, by form, a table. The forms are the differences from the
    leader (1) and from the empty set (2). Members meet if they differ in c: those near a leader
    have one c, as have those of one cluster, who meet by its core."""
    open_groups = state.where("not near and d_prefix > 0").select("g").distinct()
    by_leader = state.join(open_groups, "g", "left_semi").where("d_prefix > 0").select(
        "g", "x", F.expr("if(near, lead, cl)").alias("c"), "n", F.expr("not near").alias("asks"),
        F.col("delta").alias("s"), F.col("d_prefix").alias("prefix"))
    by_empty = state.where("o_prefix > 0").select(
        "g", "x", F.col("cl").alias("c"), "n", F.expr("delta is null").alias("asks"),
        F.col("own").alias("s"), F.col("o_prefix").alias("prefix"))
    return stored(_rarest(by_leader).withColumn("form", F.lit(1)).unionByName(
        _rarest(by_empty).withColumn("form", F.lit(2))), "fronts")


def _core_fronts(cores: DataFrame) -> DataFrame:
    """The same by the differences from the core of a cluster, form 3, for all its members."""
    rows = cores.where("prefix > 0").select(
        F.col("cl").alias("g"), "x", F.expr("if(near, head, x)").alias("c"), "n", F.expr("not near").alias("asks"),
        F.col("d").alias("s"), "prefix")
    return stored(_rarest(rows).withColumn("form", F.lit(3)), "core-fronts")


def _meeting(rows: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Rows of two members that have an element of their prefixes in common, differ in c, and of which one
    asks: members between ask near ones and each other, remote ones all that are not near. Most members
    that have an element may have the same c; they are met, but do not meet each other. Nor do members whose
    sizes or parity bits alone show that they do not link: members of a large family that nearly link have
    elements in common, each with each."""
    key = ["g", "form", "e"]
    largest = (rows.groupBy(*key, "c").agg(F.count("*").alias("many"), F.max("asks").alias("asked"))
               .groupBy(*key).agg(F.max(F.struct("many", "c")).alias("top"), F.count("*").alias("kinds"),
                                  F.max("asked").alias("asked"))
               .where("kinds > 1 and asked").select(*key, F.col("top.c").alias("top")))
    shared = stored(rows.join(largest, key).join(bits, "x"), "shared")
    a, b = shared.where("c != top").alias("a"), shared.alias("b")
    differing = sum(F.bit_count(F.col("a.bits")[i].bitwiseXOR(F.col("b.bits")[i])) for i in range(PARITIES // 64))
    met = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.form") == F.col("b.form")) & (F.col("a.e") == F.col("b.e"))
                 & (F.col("a.c") != F.col("b.c")) & (F.col("a.asks") | F.col("b.asks"))
                 & ((F.col("b.c") == F.col("b.top")) | (F.col("a.x") < F.col("b.x")))
                 & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
                 & ((100 + percent) * differing <= (100 - percent) * (F.col("a.n") + F.col("b.n"))))
    # which of two stands left differs by element, as the top c does; a pair is one whatever its elements are
    one, two = (F.struct(*(F.col(f"{t}.{k}") for k in ("x", "n", "far", "i"))) for t in "ab")
    out = met.select(F.col("a.form").alias("form"), F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
    out.read_from = shared
    return out


def _derived(state: DataFrame, member: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Links between members, at least one of which does not link with their leader, and the tables that
    they are read from. They connect what is connected; members near one core are not compared."""
    clusters = _clusters(state, member)
    cores = _from_cores(state, clusters, percent)
    near = stored(cores.where("near and x != head").select(F.col("x").alias("a"), F.col("head").alias("b")), "near")
    fronts = _fronts(state.join(clusters, "x", "left").withColumn("cl", F.coalesce("cl", "x")))
    by_core = _core_fronts(cores)
    discard(clusters.read_from, cores.read_from)
    met = _meeting(fronts.unionByName(by_core), state.select("x", "bits"), percent)
    # Differences stand in one order in all members of a group. What two have in common beside the
    # elements that their prefixes share comes after the last of these in both.
    many = [F.count("*").alias("both"), F.max("a.i").alias("i"), F.max("b.i").alias("j")]
    total = F.col("n1") + F.col("n2")
    shared = F.col("both") + F.least(F.col("far1") - F.col("i"), F.col("far2") - F.col("j")) - 1  # at most
    pairs = stored(
        met.groupBy("form", F.col("a.x").alias("x"), F.col("b.x").alias("y"), F.col("a.n").alias("n1"),
                    F.col("b.n").alias("n2"), F.col("a.far").alias("far1"), F.col("b.far").alias("far2")).agg(*many)
        .where((100 + percent) * (F.col("far1") + F.col("far2") - 2 * shared) <= (100 - percent) * total)
        .select("form", "x", "y", "n1", "n2"), "pairs")
    discard(fronts, by_core, met.read_from)
    ids = pairs.select("x").unionByName(pairs.select(F.col("y").alias("x"))).distinct()
    used = stored(state.join(ids, "x", "left_semi").select("x", "delta", "own"), "open")

    def linked(where, column):
        d1, d2 = F.col("d1"), F.col("d2")
        one = used.select("x", F.col(column).alias("d1"))
        two = used.select(F.col("x").alias("y"), F.col(column).alias("d2"))
        differing = F.size(d1) + F.size(d2) - 2 * F.size(F.array_intersect(d1, d2))
        return (pairs.where(where).join(one, "x").join(two, "y")
                .where((100 + percent) * differing <= (100 - percent) * total)
                .select(F.col("x").alias("a"), F.col("y").alias("b")))

    links = linked("form = 1", "delta").unionByName(linked("form > 1", "own"))
    return near.unionByName(links), [near, pairs, used]
