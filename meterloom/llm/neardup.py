"""Near-duplicates by SetSketch: sketch, band, estimate, verify, and an exact way for crowded bands.

1. Every text becomes its set of word shingles and a sketch of ``registers`` exponentially spaced
   truncated minima: ``K = floor(1 - log_b(h))`` of the smallest of exponential hashes. Sketches of
   parts merge by maximum, and equal registers are as likely as the sets are alike. Texts with equal
   sets (by a 128-bit digest) are one class from here on.
2. Bands of ``rows`` registers are hashed; classes that share a band meet. No pairs are listed: in each
   band the class with the most company in all its bands is the hub, and the others pair with it.
3. Such a pair's similarity is estimated from both sketches by maximum likelihood over (greater, less,
   equal) register counts and set sizes; six standard errors below the threshold rule a link out.
   The rest is verified on the full sets.
4. Members of one hub that it doesn't link may still be linked to each other. Only hubs whose members
   have different labels (components so far) stay open. Two sets whose differences from the hub are X and Y
   have the difference X ^ Y, so a link needs a known overlap of X and Y, and for the partner of an
   unlinked member at least (1 - a) / 2 of its own difference, with a = (1 - t) / (1 + t). Elements that one
   label alone has can't matter. The others are ordered by frequency and joined on that share of each
   member's rarest, a row a label and not a member, with bounds by place and by shared elements in the
   join. Two labels that may be near are compared at their centres (the hub, or one member): a link there
   merges them; else the triangle inequality with the members' distances from their centres (one
   comparison a member) tells which members, if any, could reach across, and those alone are joined by
   member. So the crowds of two revisions beside one hub cost one pair, not their product, and every pair
   that shares a band is still decided, without caps.
5. Components of the links.

With 24 bands of 4 a link at similarity 0.85 shares no band once in 5 * 10^7, at 0.8 once in 3 * 10^5.

Defined results: a null text, or one without words, has no shingles and is linked with nothing; fewer
words than ``width`` are one shingle; repeated rows are copies; rows of one doc_id with different texts
are judged each by its own text; a row with a null doc_id is linked with nothing and kept; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import every, sent, stored, text_key, tidy
from meterloom.llm.graph import components
from meterloom.llm.shingles import constants, mixed, shingle_sets

BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
#: Base and rate of the sketch; registers are 16 bits.
BASE, RATE = 1.001, 20.0

_FACTORS, _SHIFTS = constants(REGISTERS, 3), constants(REGISTERS, 4)
_TEXTS = 256  # that are hashed at a time


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of one set; the maximum of two sketches is the sketch of the union."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(least, (shingles[i : i + 512, None] * _FACTORS + _SHIFTS).min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    with np.errstate(divide="ignore"):
        spaced = np.floor(1 - np.log(-np.log1p(-uniform) / RATE) / np.log(BASE))
    return np.clip(spaced, 0, 65535).astype("<u2")


def digest(shingles: np.ndarray) -> bytes:
    """128 bits of a set: sums of two mixes of its hashes."""
    a = np.sum(mixed(shingles + _FACTORS[0]), dtype=np.uint64)
    b = np.sum(mixed(shingles ^ _FACTORS[1]) * _FACTORS[2], dtype=np.uint64)
    return np.array([a, b], "<u8").tobytes()


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, grid: int = 200) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches (rows) with known set sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u = na / (na + nb)
    v = 1 - u
    top = np.minimum(u / v, v / u)
    js = top[:, None] * np.linspace(0, 1, grid + 1)[None, :]

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u[:, None] - v[:, None] * js), p(v[:, None] - u[:, None] * js)
    tiny = 1e-12
    likelihood = (
        more[:, None] * np.log(up + tiny) + less[:, None] * np.log(down + tiny)
        + same[:, None] * np.log(np.maximum(1 - up - down, 0) + tiny)
    )
    return js[np.arange(len(js)), likelihood.argmax(1)]


def _sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    for i in range(0, len(texts), _TEXTS):
        with np.errstate(over="ignore"):
            yield from shingle_sets(texts[i : i + _TEXTS], width)


def sketches(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, text_key, n_shingles, node (digest of the set) and registers of every row."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node, registers = [], [], []
            for i in range(0, batch.num_rows, _TEXTS):
                for s in _sets(batch.column(1).slice(i, _TEXTS).to_pylist(), width):
                    n.append(len(s))
                    with np.errstate(over="ignore"):
                        node.append(digest(s) if len(s) else None)
                        registers.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(registers, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "node", "registers"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    columns = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    return columns.mapInArrow(tidy(made), f"doc_id {kind}, text_key binary, n_shingles long, node binary, registers binary")


def full_sets(docs: DataFrame, width: int = 5) -> DataFrame:
    """node, registers and shingles (sorted unsigned 64-bit hashes) of rows with words."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _TEXTS):
                sets = [s for s in _sets(batch.column(0).slice(i, _TEXTS).to_pylist(), width) if len(s)]
                with np.errstate(over="ignore"):
                    columns = [[digest(s) for s in sets], [sketch(s).tobytes() for s in sets], [s.tobytes() for s in sets]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["node", "registers", "shingles"])

    return docs.select("text").mapInArrow(tidy(made), "node binary, registers binary, shingles binary")


def hub_pairs(classes: DataFrame) -> DataFrame:
    """hub, node: in each band every class pairs with the one that has the most company."""
    band = lambda i: F.xxhash64(F.lit(i), F.substring("registers", 2 * ROWS * i + 1, 2 * ROWS))
    bands = classes.select("node", F.explode(F.array(*[band(i) for i in range(BANDS)])).alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("company")).where("company > 1")
    members = stored(bands.join(shared, "band"), "band-members")
    votes = members.groupBy("node").agg(F.sum("company").alias("votes"))
    hubs = members.join(votes, "node").groupBy("band").agg(F.max(F.struct("votes", "node")).alias("top"))
    hubs = hubs.select("band", F.col("top.node").alias("hub"))
    return members.join(hubs, "band").where("node <> hub").select("hub", "node").distinct()


_COMPARED = "a binary, b binary, n_a long, n_b long, estimate double, linked boolean, apart long"
_GROUP = 2048  # members that meet one copy of their hub
_BATCH_BYTES = 8 << 20
_FEW = 500_000  # ids, about 16 MB where they are broadcast


def _beside_hubs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, member, node, registers, shingles: each ``a`` with its set, then the ``b`` of its pairs, in one partition.

    A hub comes once for so many members; one with more is split into salted groups.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / _GROUP).cast("int").alias("groups")).where("groups > 1")
    salted = pairs.select("a", "b").join(many, "a", "left")
    salted = salted.select("a", "b", F.expr("pmod(xxhash64(b), coalesce(groups, 1))").cast("int").alias("salt"))
    hubs = salted.select("a", "salt", F.lit(False).alias("member"), F.col("a").alias("node")).distinct()
    members = salted.select("a", "salt", F.lit(True).alias("member"), F.col("b").alias("node"))
    rows = hubs.union(members).join(sets, "node").select("a", "salt", "member", "node", "registers", "shingles")
    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "member").drop("salt")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Nodes, registers and sets of up to _TEXTS pairs at a time, from rows where hubs come before their members."""
    hub, held = None, []
    for batch in batches:
        columns = batch.columns
        for i in range(batch.num_rows):
            node, registers, shingles = (columns[k][i].as_buffer() for k in (2, 3, 4))
            # Copies, so that a held row doesn't hold its batch.
            own = node.to_pybytes(), np.frombuffer(registers, "<u2").copy(), np.frombuffer(shingles, np.uint64).copy()
            if not columns[1][i].as_py():
                hub = own
                continue
            held.append((*hub, *own))
            if len(held) == _TEXTS:
                yield tuple(zip(*held, strict=True))
                held = []
    if held:
        yield tuple(zip(*held, strict=True))


def compared(pairs: DataFrame, sets: DataFrame, percent: int, *, exact: bool = False) -> DataFrame:
    """Pairs a, b with sizes, estimate, verified link and the size of their difference.

    Unless it is ``exact``, a pair whose estimate is far below the threshold isn't verified and has no ``apart``.
    """
    floor = percent / 100 - 6 * np.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, ra, sa, b, rb, sb in _met(batches):
            na, nb = np.array([len(x) for x in sa]), np.array([len(x) for x in sb])
            guess = estimate(np.stack(ra), np.stack(rb), na, nb)
            apart: list[int | None] = [
                len(np.setxor1d(x, y, assume_unique=True)) if exact or g >= floor else None
                for x, y, g in zip(sa, sb, guess.tolist(), strict=True)
            ]
            # |x & y| = (together - apart) / 2 and |x | y| = (together + apart) / 2
            linked = [
                g >= floor and 100 * (t - d) >= percent * (t + d)
                for t, d, g in zip((na + nb).tolist(), apart, guess.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(na, pa.int64()), pa.array(nb, pa.int64()),
                 pa.array(guess), pa.array(linked, pa.bool_()), pa.array(apart, pa.int64())],
                ["a", "b", "n_a", "n_b", "estimate", "linked", "apart"],
            )

    return _beside_hubs(pairs, sets).mapInArrow(tidy(verified), _COMPARED)


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs a, b with b's size and the keys of the hub and each element of the difference."""

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, _, sa, b, _, sb in _met(batches):
            with np.errstate(over="ignore"):
                keys = [
                    mixed(np.setxor1d(x, y, assume_unique=True) + np.frombuffer(h, np.uint64)[0]).view(np.int64)
                    for h, x, y in zip(a, sa, sb, strict=True)
                ]
            offsets = np.cumsum([0] + [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array([len(y) for y in sb], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(keys)))],
                ["a", "b", "n", "keys"],
            )

    return _beside_hubs(pairs, sets).mapInArrow(tidy(exploded), "a binary, b binary, n long, keys array<bigint>")


def _may_overlap():
    """Whether the shared elements that are left suffice for a link."""
    return (F.col("slack_b") + F.col("slack_c")) / 2 - 1e-6 <= F.least("rest_b", "rest_c")


def within_hubs(stars: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links a, b that connect members of one hub which have different labels (components so far).

    All steps but the last work on labels in a hub, not on members, so two crowds beside one hub are one pair.
    """
    alpha = (100 - percent) / (100 + percent)
    label = lambda node, name: labels.select(F.col("node").alias(node), F.xxhash64("label").alias(name))
    own = lambda name, node: F.coalesce(name, F.xxhash64(node))
    members = stars.select("a", "b", "linked").join(label("b", "l_b"), "b", "left").join(label("a", "l_a"), "a", "left")
    members = members.select("a", "b", "linked", own("l_b", "b").alias("label"), own("l_a", "a").alias("l_a"))
    # With two members or more and one label or more that isn't the hub's.
    crowd = members.groupBy("a").agg(F.count("*").alias("n"), F.max(F.col("label") != F.col("l_a")).alias("open"))
    members = stored(members.join(crowd.where("open AND n > 1").select("a"), "a"), "open-members")
    if members.isEmpty():
        return stars.select("a", "b").limit(0)
    found = stored(differences(members, sets), "hub-differences", batch_bytes=_BATCH_BYTES, compression="zstd")

    # Elements of differences, of those that two labels share; rarest first in each member.
    about = members.join(found, ["a", "b"]).withColumn("star", F.xxhash64("a", "b")).withColumn("size", F.size("keys"))
    rows = about.select("star", "label", F.explode("keys").alias("key"))
    often = rows.groupBy("key").agg(F.count("*").alias("df"), F.min("label").alias("least"), F.max("label").alias("most"))
    often = often.where("least <> most").select("key", "df")
    ordered = rows.join(often, "key").groupBy("star").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("keys"))
    places = ordered.withColumn("shared", F.size("keys")).join(about.drop("keys"), "star")
    places = places.select("a", "b", "n", "label", "l_a", "linked", "size", "shared", F.posexplode("keys").alias("at", "key"))
    slack = F.col("size") - alpha * F.col("n")
    places = places.select(
        "a", "b", "n", "label", "l_a", "linked", "size", F.col("key.key").alias("key"),
        (F.col("shared") - F.col("at")).cast("double").alias("rest"), slack.alias("slack"),
    )
    places = stored(places, "star-places", compression="zstd")
    index = places.where(F.col("rest") >= F.ceil(F.col("size") * (1 - alpha) / 2 - 1e-9))
    probe = places.where("NOT linked")

    def crowds(some: DataFrame, side: str) -> DataFrame:
        best = some.groupBy("key", "label").agg(F.min("slack"), F.max("rest"), F.first("a"))
        return best.toDF("key", f"l_{side}", f"slack_{side}", f"rest_{side}", f"hub_{side}")

    b, c = crowds(index, "b"), crowds(probe, "c")
    possible = (b["l_b"] != c["l_c"]) & _may_overlap()
    met = b.join(c, (b["key"] == c["key"]) & possible)
    met = met.select(b["key"], F.col("hub_b").alias("hub"), "l_b", "l_c", "slack_c", "rest_c")
    met = stored(met, "label-meetings", compression="zstd")
    pairs = stored(met.select("hub", "l_b", "l_c").distinct(), "label-pairs")

    # A label's centre beside a hub is the hub or one of its members; pairs of centres are decided first.
    centre = members.groupBy("a", "label").agg(
        F.min("b").alias("b"), F.count("*").alias("crowd"), F.max(F.col("label") == F.col("l_a")).alias("home")
    )
    centre = centre.select(
        F.col("a").alias("hub"), "label", F.when(F.col("home"), F.col("a")).otherwise(F.col("b")).alias("centre"),
        (F.col("home") | (F.col("crowd") > 1)).alias("crowded"),
    )
    of = lambda side: centre.toDF("hub", f"l_{side}", f"centre_{side}", f"crowded_{side}")
    named = pairs.join(of("b"), ["hub", "l_b"]).join(of("c"), ["hub", "l_c"])
    ends = (F.least("centre_b", "centre_c"), F.greatest("centre_b", "centre_c"))
    named = stored(named.select("*", ends[0].alias("a"), ends[1].alias("b")), "named-pairs")
    decided = compared(named.select("a", "b").distinct(), sets, percent, exact=True)
    decided = stored(decided, "centre-pairs", batch_bytes=_BATCH_BYTES)
    links = decided.where("linked").select("a", "b")
    close = named.where("crowded_b OR crowded_c").join(decided.where("NOT linked").select("a", "b", "apart"), ["a", "b"])
    close = stored(close.select("hub", "l_b", "l_c", "centre_b", "centre_c", "apart"), "close-labels")
    if close.isEmpty():
        return links

    # reach = distance from the centre + alpha * n: |x ^ y| >= apart - reach(x) - reach(y) + alpha (n_x + n_y).
    asked = close.select("hub", F.col("l_b").alias("label")).union(close.select("hub", F.col("l_c").alias("label"))).distinct()
    beside = members.withColumnRenamed("a", "hub").join(asked.join(centre, ["hub", "label"]), ["hub", "label"])
    away = beside.where("centre <> hub AND centre <> b").select(F.col("centre").alias("a"), "b").distinct()
    away = stored(compared(away, sets, percent, exact=True), "radii", batch_bytes=_BATCH_BYTES)
    sizes = found.select(F.col("a").alias("hub"), "b", "n", F.size("keys").alias("from_hub"))
    beside = beside.join(sizes, ["hub", "b"]).join(away.select(F.col("a").alias("centre"), "b", "apart"), ["centre", "b"], "left")
    radius = F.when(F.col("centre") == F.col("hub"), F.col("from_hub")).otherwise(F.coalesce("apart", F.lit(0)))
    reach = stored(beside.select("hub", "label", "b", (radius + alpha * F.col("n")).alias("reach")), "reaches")
    # The hub itself is no member: it is compared with all of them already.
    most = reach.groupBy("hub", "label").agg(F.max("reach").alias("most"))
    close = close.join(most.toDF("hub", "l_b", "most_b"), ["hub", "l_b"]).join(most.toDF("hub", "l_c", "most_c"), ["hub", "l_c"])
    close = stored(close.where(F.col("most_b") + F.col("most_c") >= F.col("apart") - 1e-6), "near-labels")
    if close.isEmpty():
        return links
    def reached(some: DataFrame, side: str) -> DataFrame:
        rows = some.select(F.col("a").alias("hub"), "label", "b", "key", "slack", "rest").join(reach, ["hub", "label", "b"])
        return rows.select(
            "key", F.col("label").alias(f"l_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in ("b", "slack", "rest", "reach")]
        )

    # Key by key: the members of one label that may meet the other label there, then the other's members.
    near = met.join(close.select("hub", "l_b", "l_c", "apart", "most_c"), ["hub", "l_b", "l_c"])
    x = reached(index, "b")
    meets = (near["key"] == x["key"]) & (near["l_b"] == x["l_b"]) & (F.col("reach_b") >= F.col("apart") - F.col("most_c") - 1e-6)
    half = near.join(x, meets & _may_overlap()).select(near["key"], "l_c", "apart", F.col("b_b").alias("x"), "slack_b", "rest_b", "reach_b")
    y = reached(probe, "c")
    meets = (half["key"] == y["key"]) & (half["l_c"] == y["l_c"]) & (F.col("reach_b") + F.col("reach_c") >= F.col("apart") - 1e-6)
    some = half.join(y, meets & _may_overlap()).select(F.col("x").alias("node_b"), F.col("b_c").alias("node_c"))
    some = some.select(F.least("node_b", "node_c").alias("a"), F.greatest("node_b", "node_c").alias("b")).distinct()
    more = stored(compared(stored(some, "more-pairs"), sets, percent), "more-links", batch_bytes=_BATCH_BYTES)
    return links.union(more.where("linked").select("a", "b"))


def linked_components(docs: DataFrame, percent: int = 85, width: int = 5) -> DataFrame:
    """doc_id, text_key, n_shingles, node and component_id (the smallest doc_id that is reached) of every row.

    ``chosen`` holds for the rows with the id and the set that stand for their component.
    """
    docs = docs.select("doc_id", "text")
    rows = stored(sketches(docs, width), "sketches", batch_bytes=_BATCH_BYTES)
    classes = rows.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node")
    classes = stored(classes.agg(F.min("doc_id").alias("first_id"), F.first("registers").alias("registers")), "classes")
    pairs = stored(hub_pairs(classes), "hub-pairs")
    met = pairs.select("hub").union(pairs.select("node")).distinct().select(F.col("hub").alias("node"))
    ids = stored(met.join(classes, "node").select(F.col("first_id").alias("doc_id")).distinct(), "met-ids")
    # Texts stay where they are while the ids are few enough to go to every task.
    few = ids.count() <= _FEW
    texts = docs.join(F.broadcast(ids) if few else ids.hint("shuffle_hash"), "doc_id", "left_semi")
    sets = stored(full_sets(texts, width).dropDuplicates(["node"]), "shingle-sets", batch_bytes=_BATCH_BYTES)
    stars = pairs.select(F.col("hub").alias("a"), F.col("node").alias("b"))
    stars = stored(compared(stars, sets, percent), "stars", batch_bytes=_BATCH_BYTES)
    links = stars.where("linked").select("a", "b")
    labels = components(links)
    more = stored(within_hubs(stars, labels, sets, percent), "within-hubs")
    if not more.isEmpty():
        labels = components(links.union(more))
    named = classes.select("node", "first_id").join(labels, "node")
    first = named.groupBy("label").agg(F.min(F.struct("first_id", "node")).alias("first"))
    first = first.select("label", F.col("first.first_id").alias("component"), F.col("first.node").alias("stands"))
    component = named.join(first, "label").select("node", "component", "stands")
    component = classes.select("node", "first_id").join(component, "node", "left")
    # Stored, so that the copies of a hot class meet it in a join that Spark can split.
    stands = F.coalesce(F.col("stands") == F.col("node"), F.lit(True)).alias("stands")
    component = stored(component.select("node", F.coalesce("component", "first_id").alias("component"), stands), "class-components")
    joined = rows.drop("registers").join(component, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    chosen = F.coalesce(F.col("stands") & (F.col("doc_id") == F.col("component")), F.lit(True))
    return joined.select("doc_id", "text_key", "n_shingles", "node", own.alias("component_id"), chosen.alias("chosen"))


def op6(docs: DataFrame, percent: int = 85) -> DataFrame:
    found = linked_components(docs, percent)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: DuckDB SQL for the query: all pairs that share a shingle, then reachability.
ORACLE_OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) >= 5 THEN list_distinct(list_transform(range(1, len(words) - 3),
      lambda i: array_to_string(words[i:i + 4], ' ')))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles FROM w
), sized AS (
  SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n, shingles FROM sets
), s AS (
  SELECT doc_id, n, unnest(shingles) AS shingle FROM sized
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sized UNION SELECT r.doc_id, e.y FROM reached r JOIN edges e ON r.other = e.x
), named AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT sized.doc_id, n AS n_shingles, component_id, sized.doc_id = component_id AS kept
FROM sized JOIN named ON sized.doc_id = named.doc_id
"""


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each group, with all its columns; texts without words go only as repeated rows of one id."""
    found = linked_components(docs, percent).where("doc_id IS NOT NULL")
    found = found.groupBy("doc_id", "text_key").agg(
        F.first("node").alias("node"), F.first("chosen").alias("chosen"), F.count("*").alias("n")
    )
    # Texts of one id that differ in case or spaces have one set: the first of them stands.
    alike = Window.partitionBy("doc_id", F.coalesce("node", "text_key"))
    found = found.withColumn("chosen", F.col("chosen") & (F.col("text_key") == F.min("text_key").over(alike)))
    found = stored(found.where("NOT chosen OR n > 1").select("doc_id", "text_key", "chosen"), "copies")
    key = text_key(F.col("text"))

    def of(rows: DataFrame, few: DataFrame, how: str) -> DataFrame:
        few = few.select(F.col("doc_id").alias("its_id"), F.col("text_key").alias("its_text"))
        # Texts stay where they are while the copies are few enough to go to every task.
        return rows.join(sent(few), (rows["doc_id"] == few["its_id"]) & (key == few["its_text"]), how)

    kept = of(docs, found.where("NOT chosen"), "left_anti")
    again = found.where("chosen")
    once = of(kept, again, "left_anti")
    one = of(kept, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.select(every(docs.columns)).union(one.select(every(docs.columns)))
