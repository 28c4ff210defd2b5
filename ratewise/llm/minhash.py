"""MinHash near-duplicates: a chosen-path set similarity join.

Documents become sets of word shingles (64-bit hashes).  Equal sets form a class
and are joined once, by their digest; the classes' representatives go on.

*Chosen paths.*  A set is embedded as ``COORDS`` minwise tokens, so that two sets
agree in a coordinate with probability equal to their Jaccard similarity.  The first
nodes are bands: a member is in one node for every ``BAND`` coordinates, named by
all their tokens, so that documents that share a common line, and nothing else, seldom
meet.  Nodes of at most ``NODE`` members are compared exhaustively on the tokens.
Larger ones first compare their members with a few leaders.  Edges only have to
connect, so a member gives one, to its first near leader, and leaders near one member
are joined once a chunk.  What the leaders connect has a label; whoever is nearly equal
to a leader stays behind.  If all but ``FEW`` of a node have one label, those few meet
everyone and the node is done; else the rest branches: a node selects each coordinate
with probability ``1 / (DENSITY * COORDS)``, by a hash of its path, and a member goes to
one child for each selected coordinate, named by path, coordinate and token.  A node
whose members all have one label is dropped, since nothing below it can join anything
new.  When comparing what is still large in blocks costs no more than ``BLOCK_ROWS``
says, or after ``DEPTH`` levels, that is done.  A pair of similarity J shares a band with
probability J ** 3: it misses all 21 with about 2e-9 at 0.85 and 3e-7 at 0.8, and, as it
shares a child of a node with probability ``1 - exp(-J / DENSITY)`` (0.94 and 0.93), with
about 3e-7 and 1e-5 after three branchings.

*Verification.*  Pairs whose tokens agree often enough (``SLACK`` standard
deviations below the threshold) connect their documents into clusters; a
cluster's texts meet once, in chunks of bounded size, and links are confirmed on
the full sets.  Every document of a cluster is compared with its chunk and with
the cluster's leaders; documents outside the cluster's largest component are
then compared with all its chunks.  Pairs already connected need no second
proof, so groups of thousands of copies cost one comparison a copy, not all
pairs.

Cases: null text, empty text and text of white space have the empty set and are
linked with nothing (each is its own component); fewer words than a shingle
are one shingle of all words; very long texts are whole; repeated rows with one
id are one document per row and share its component; null ids are dropped; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (Forest, components, let_go, mix, plain, read, runs, shingle_sets, sized,
                     small_batches, stored)

COORDS, BAND, DENSITY = 64, 3, 0.3
NODE, DEPTH, LEADERS, SAME = 96, 4, 12, 0.88
#: What the leaders leave of large nodes is compared in blocks as soon as that
#: moves at most so many rows per representative; until then it branches.
BLOCK_ROWS = 2
SLACK = 4.5
#: Members of a large node that are compared with its leaders at a time.
LED = 1024
#: Members of a node that the leaders have not connected and that meet all others.
FEW = 4 * NODE
#: Texts of a verification chunk.
CHUNK = 192

_U = np.uint64
_RNG = np.random.default_rng(11)
_FACTOR = _RNG.integers(1, 1 << 62, COORDS, dtype=np.uint64) * _U(2) + _U(1)
_OFFSET = _RNG.integers(0, 1 << 62, COORDS, dtype=np.uint64)
_WHICH = mix(np.arange(1, COORDS + 1, dtype=np.uint64))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Minwise tokens (uint32) of non-empty sets."""
    out = np.empty((len(sets), COORDS), np.uint32)
    if not sets:
        return out
    all_, starts = np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    for j in range(COORDS):
        least = np.minimum.reduceat(all_ * _FACTOR[j] + _OFFSET[j], starts)
        out[:, j] = (mix(least) >> _U(32)).astype(np.uint32)
    return out


def _children(paths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, child path)`` of every coordinate that the rows' nodes select."""
    chosen = mix(paths[:, None] ^ _WHICH[None]) < _U(int(2.0 ** 64 / (DENSITY * COORDS)))
    row, j = np.nonzero(chosen)
    return row, mix(mix(paths[row] + _WHICH[j]) ^ tokens[row, j].astype(np.uint64))


def _tokens(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, COORDS)


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Coordinates in which each row of ``a`` agrees with each row of ``b``."""
    if len(a) * len(b) <= 1024:
        return (a[:, None] == b[None]).sum(2)
    out = np.zeros((len(a), len(b)), np.int8)
    for j in range(a.shape[1]):
        out += a[:, j, None] == b[None, :, j]
    return out


def _star_edges(ids: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the first id of each connected group of a symmetric matrix."""
    first = np.arange(len(ids))
    while True:
        new = np.minimum(first, np.where(near, first[None], len(ids)).min(1))
        new = new[new]
        if (new == first).all():
            break
        first = new
    rest = np.flatnonzero(first != np.arange(len(ids)))
    return ids[first[rest]], ids[rest]


def _least_agreement(threshold: float) -> int:
    return int(np.floor(COORDS * threshold - SLACK * np.sqrt(COORDS * threshold * (1 - threshold))))


EDGES = "a long, b long"


def document_sets(documents: DataFrame, words: int) -> DataFrame:
    """``(doc_id, n_shingles, digest, sketch)``; digest and sketch are null for
    the empty set."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        for pdf in batches:
            texts = list(pdf["text"])
            for i, sets in shingle_sets(texts, words):
                full = [s for s in sets if len(s)]
                sketch = iter(sketches(full))
                rows = [(len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                         next(sketch).tobytes()) if len(s) else (0, None, None) for s in sets]
                out = pd.DataFrame(rows, columns=["n_shingles", "digest", "sketch"])
                out.insert(0, "doc_id", pdf["doc_id"].to_numpy()[i:i + len(sets)])
                yield out

    return plain(documents, doc_id="long", text="string").where("doc_id IS NOT NULL").mapInPandas(
        run, "doc_id long, n_shingles long, digest binary, sketch binary")


# --- the trees ---------------------------------------------------------------------------

def _grow(nodes: DataFrame) -> DataFrame:
    """``nodes(path, rep, sketch, label)`` to their children ``(path, rep, label)``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                row, path = _children(pdf["path"].to_numpy().astype(np.uint64), _tokens(pdf["sketch"]))
                yield pd.DataFrame({"path": path.astype(np.int64), "rep": pdf["rep"].to_numpy()[row],
                                    "label": pdf["label"].to_numpy()[row]})
    # no label is -1 here: a null would make the column a float in pandas
    coded = nodes.select("path", "rep", "sketch", F.coalesce("label", F.lit(-1)).alias("label"))
    return coded.mapInPandas(run, "path long, rep long, label long").withColumn(
        "label", F.nullif("label", F.lit(-1)))


def _roots(reps: DataFrame) -> DataFrame:
    """The first nodes ``(path, rep, label)``: one a band for every representative, named
    by the band and its tokens."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            tokens = _tokens(pdf["sketch"])
            for band in range(COORDS // BAND):
                path = np.full(len(pdf), band + 101, np.uint64)
                for j in range(band * BAND, (band + 1) * BAND):
                    path = mix(mix(path + _WHICH[j]) ^ tokens[:, j].astype(np.uint64))
                yield pd.DataFrame({"path": path.astype(np.int64), "rep": pdf["rep"].to_numpy()})
    return reps.mapInPandas(run, "path long, rep long").withColumn("label", F.lit(None).cast("long"))


def _compare(groups: DataFrame, keys: list[str], least: int) -> DataFrame:
    """All pairs of each small group (sorted by ``keys``): star edges."""
    def edges(rep: np.ndarray, tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
        two = starts[ends - starts == 2]
        two = two[(tokens[two] == tokens[two + 1]).sum(1) >= least]
        a, b = [rep[two]], [rep[two + 1]]
        for i, j in zip(starts, ends):
            if j - i > 2:
                x, y = _star_edges(rep[i:j], _agree(tokens[i:j], tokens[i:j]) >= least)
                a.append(x)
                b.append(y)
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last group of a batch may go on in the next
        for pdf in batches:
            if not len(pdf):
                continue
            now = [pdf[keys].to_numpy(), pdf["rep"].to_numpy(), _tokens(pdf["sketch"])]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            cuts = np.concatenate(([0], np.flatnonzero((now[0][1:] != now[0][:-1]).any(1)) + 1))
            yield edges(now[1], now[2], cuts[:-1], cuts[1:])
            held = [x[cuts[-1]:] for x in now]
        if held is not None:
            yield edges(held[1], held[2], np.array([0]), np.array([len(held[1])]))

    return groups.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInPandas(run, EDGES)


def _undecided(nodes: DataFrame) -> DataFrame:
    """``(path, n)`` of nodes with two members that are not known to be connected."""
    return nodes.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"),
        F.min("label").alias("low"), F.max("label").alias("high")).where(
        "n > 1 AND NOT (labelled = n AND low = high)").select("path", "n")


def candidate_edges(reps: DataFrame, threshold: float) -> DataFrame:
    """Edges that connect all representatives whose tokens agree often enough
    and that share a node: ``reps(rep, sketch)`` -> ``(a, b)``."""
    least, same = _least_agreement(threshold), int(SAME * COORDS)
    found: list[DataFrame] = []
    nodes, total = _roots(reps), reps.count()
    for depth in range(1, DEPTH + 1):
        nodes = stored(nodes, "children") if depth > 1 else nodes
        sizes = stored(_undecided(nodes), "sizes")
        # only (path, rep) meets the sizes; sketches go to members that have company
        shared = nodes.join(sized(sizes), "path")
        members = stored(shared.select("path", "n", "rep").join(reps.hint("merge"), "rep"), "nodes")
        small = members.where(F.col("n") <= NODE).select("path", "rep", "sketch")
        found.append(stored(_compare(small, ["path"], least).distinct(), "edges"))
        large = members.where(F.col("n") > NODE)
        if not sizes.where(F.col("n") > NODE).limit(1).count():
            break
        # leaders: the members with the smallest of several hashes
        pick = lambda k: F.min(F.struct(F.xxhash64("rep", "path", F.lit(k)), "rep", "sketch"))
        leaders = stored(large.groupBy("path").agg(
            F.array(*[pick(k) for k in range(LEADERS)]).alias("l"), F.max("n").alias("n")), "leaders")
        chunk = F.ceil(F.col("n") / LED).cast("int")
        dealt = large.select("path", F.pmod(F.xxhash64("rep"), chunk).cast("int").alias("c"), "rep", "sketch",
                             F.lit(False).alias("leads")).unionAll(
            leaders.withColumn("c", F.explode(F.sequence(F.lit(0), chunk - 1))).select(
                "path", "c", F.explode("l").alias("l")).select("path", "c", "l.rep", "l.sketch", F.lit(True)))
        led = stored(dealt.repartition("path", "c").sortWithinPartitions("path", "c").mapInPandas(
            _with_leaders(least, same), "path long, rep long, sketch binary, label long, a long"), "led")
        found.append(led.where("a >= 0").select("a", F.col("rep").alias("b")))
        rest = led.where("sketch IS NOT NULL").select(
            "path", "rep", "sketch", F.nullif("label", F.lit(-1)).alias("label"))
        by_label = rest.groupBy("path", "label").agg(F.count(F.lit(1)).alias("m"))
        known = F.when(F.col("label").isNotNull(), F.struct("m", "label"))
        counts = stored(by_label.groupBy("path").agg(F.sum("m").alias("n"), F.max(known).alias("main")).select(
            "path", "n", F.col("main.label").alias("main"),
            (F.col("n") - F.coalesce(F.col("main.m"), F.lit(0))).alias("others")).where("n > 1 AND others > 0"),
            "counts")
        # all but a few are connected: those few meet everyone
        few = F.col("others") <= FEW
        near_done = counts.where(few)
        if near_done.limit(1).count():
            found.append(stored(_strangers(rest.join(sized(near_done), "path"), least).distinct(), "edges"))
        counts = counts.where(~few)
        moved = counts.agg(F.sum(F.col("n") * F.ceil(F.col("n") / NODE))).first()[0]
        if not moved:
            break
        rest = rest.join(sized(counts), "path")
        if depth == DEPTH or moved <= BLOCK_ROWS * total:
            found.append(stored(_blocks(rest, least).distinct(), "edges"))
            break
        nodes = _grow(rest)
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out.distinct()


def _with_leaders(least: int, same: int):
    """Chunks ``(path, c, rep, sketch, leads)`` of large nodes, the leaders in each.  Gives
    every member: ``a``, its first near leader (-1: none), and ``label``, the least of the
    leaders that it is connected with through the chunk (-1: none); and the edges that
    join the leaders, as rows without a path.

    A member that is nearly equal to a leader (not a leader itself) loses its sketch, so
    it branches no further: what is linked to such a member is near its leader too
    (1 - similarity is a metric), and other nodes have other leaders."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["path", "c"]):
            leaders = group[group["leads"]].drop_duplicates("rep").sort_values("rep")
            members = group[~group["leads"]]
            if not len(members):
                continue
            ids, rep = leaders["rep"].to_numpy(), members["rep"].to_numpy()
            agree = _agree(_tokens(members["sketch"]), _tokens(leaders["sketch"])).astype(np.int64)
            mine = rep[:, None] == ids[None]
            agree[mine] = 0
            near, own = agree >= least, mine.any(1)
            forest, joins = Forest(len(ids)), []
            for row in np.unique(near | mine, axis=0):  # of what is near one member
                at = np.flatnonzero(row)
                joins += [(at[0], j) for j in at[1:] if forest.join(at[0], j)]
            root = np.array([ids[forest.root(i)] for i in range(len(ids))])
            any_ = near.any(1)
            linked = (near | mine).any(1)
            first = near.argmax(1)
            yield pd.DataFrame({
                "path": members["path"].to_numpy(), "rep": rep,
                "sketch": members["sketch"].where((agree.max(1) < same) | own, None).to_numpy(),
                "label": np.where(linked, root[(near | mine).argmax(1)], -1),
                "a": np.where(any_ & ~own, ids[first], -1)})
            if joins:
                yield pd.DataFrame({"path": 0, "rep": [ids[j] for _, j in joins], "sketch": None,
                                    "label": -1, "a": [ids[i] for i, _ in joins]})
    return run


def _strangers(nodes: DataFrame, least: int) -> DataFrame:
    """Large nodes ``(path, n, main, rep, sketch, label)`` with few members that do not have
    the label ``main``: each of those few with all members, by chunks of the others,
    which are connected already."""
    chunk = F.ceil(F.col("n") / LED).cast("int")
    few = ~F.col("label").eqNullSafe(F.col("main"))
    dealt = nodes.withColumn("few", few).withColumn("c", F.explode(
        F.when(few, F.sequence(F.lit(0), chunk - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("rep"), chunk).cast("int"))))).select("path", "c", "rep", "sketch", "few")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["path", "c"]):
            rep, tokens = group["rep"].to_numpy(), _tokens(group["sketch"])
            those = np.flatnonzero(group["few"].to_numpy())
            near = _agree(tokens[those], tokens) >= least
            forest, a, b = Forest(len(rep)), [], []
            for i, j in zip(*np.nonzero(near)):
                i = int(those[i])
                if i != j and forest.join(i, int(j)):
                    a.append(rep[i])
                    b.append(rep[j])
            yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return dealt.repartition("path", "c").sortWithinPartitions("path", "c", "rep").mapInPandas(run, EDGES)


def _blocks(large: DataFrame, least: int) -> DataFrame:
    """Large nodes that do not branch: all pairs of chunks of their members."""
    chunks = F.ceil(F.col("n") / NODE).cast("int")
    dealt = large.withColumn("k", chunks).withColumn("c", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
    both = dealt.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "path", F.least("c", "d").alias("i"), F.greatest("c", "d").alias("j"), "rep", "sketch")
    return _compare(both, ["path", "i", "j"], least)


# --- verification ------------------------------------------------------------------------

def _linked(sets: list[np.ndarray], a: int, b: int, num: int, den: int) -> bool:
    x, y = sets[a], sets[b]
    if den * min(len(x), len(y)) < num * max(len(x), len(y)):
        return False
    both = np.concatenate((x, y))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return den * shared >= num * (len(x) + len(y) - shared)


def _confirm(groups: DataFrame, keys: list[str], words: int, num: int, den: int) -> DataFrame:
    """Groups ``(keys.., rep, text, label)``: confirmed links that connect them.
    Pairs of one non-null label are known to be connected already."""
    least = _least_agreement(num / den)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, keys):
            group = group.drop_duplicates("rep")
            ids, sets = group["rep"].to_numpy(), []
            for _, part in shingle_sets(list(group["text"]), words):
                sets += part
            tokens = sketches(sets)
            agree = np.triu(_agree(tokens, tokens), 1)
            near = np.argwhere(agree >= least)
            near = near[np.argsort(-agree[near[:, 0], near[:, 1]], kind="stable")]
            forest, edges = Forest(len(ids)), []
            labels = group["label"].to_numpy()
            first: dict = {}
            for i, label in enumerate(labels):
                if not pd.isna(label):
                    forest.join(first.setdefault(label, i), i)
            for i, j in near:
                i, j = int(i), int(j)
                if forest.root(i) != forest.root(j) and _linked(sets, i, j, num, den):
                    forest.join(i, j)
                    edges.append((int(ids[i]), int(ids[j])))
            if edges:
                yield pd.DataFrame(edges, columns=["a", "b"])

    return groups.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInPandas(run, EDGES)


def links(documents: DataFrame, edges: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Components ``(node, component)`` of the confirmed links among the
    representatives that candidate edges connect."""
    clusters = stored(components(edges), "clusters")
    sizes = clusters.groupBy("component").agg(F.count("*").alias("n"))
    chunked = stored(clusters.join(stored(sizes, "sizes"), "component")
                   .withColumn("k", F.ceil(F.col("n") / CHUNK).cast("int"))
                   .withColumn("c", F.pmod(F.xxhash64("node"), F.col("k")).cast("int")), "clusters")
    texts = plain(documents, doc_id="long", text="string").withColumnRenamed("doc_id", "rep")
    # texts are shuffled only for documents of a cluster, as long as their ids can
    # be broadcast
    members = sized(chunked.select(F.col("node").alias("rep"), "component", "k", "c"))
    rows = stored(texts.join(members, "rep"), "texts")
    # the leaders of a cluster of several chunks join every chunk
    pick = lambda s: F.min(F.struct(F.xxhash64("node", F.lit(s)), "node"))["node"]
    leaders = chunked.where("k > 1").groupBy("component").agg(F.array(*[pick(s) for s in range(4)]).alias("l"))
    lead = leaders.select(F.explode("l").alias("rep")).distinct()
    everywhere = rows.join(lead, "rep").withColumn("c", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    none = F.lit(None).cast("long").alias("label")
    cols = ["component", "c", "rep", "text"]
    found = stored(_confirm(rows.select(*cols, none).unionAll(everywhere.select(*cols, none)),
                            ["component", "c"], words, num, den), "links")
    parts = stored(components(found), "parts")
    if not chunked.where("k > 1").limit(1).count():
        return parts
    # clusters of several chunks: what is not in the largest component meets all chunks
    wide = chunked.where("k > 1").select(F.col("node").alias("rep"), "component", "k", "c")
    labelled = stored(wide.join(parts.select(F.col("node").alias("rep"), F.col("component").alias("p")),
                                "rep", "left").withColumn("label", F.coalesce("p", "rep")).drop("p"),
                      "labelled")
    count = labelled.groupBy("component", "label").agg(F.count("*").alias("m"))
    top = stored(count.groupBy("component").agg(F.max(F.struct("m", "label"))["label"].alias("main")), "main")
    apart = stored(labelled.join(top, "component").where("label <> main"), "apart")
    strays = stored(apart.groupBy("component").agg(F.count("*").alias("strays")), "strays")
    if not strays.limit(1).count():
        return parts
    split = F.ceil(F.col("strays") / CHUNK).cast("int")
    every = labelled.join(strays, "component").withColumn("ks", split)
    body = every.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("ks") - 1)))
    guests = every.join(apart.select("rep"), "rep").withColumn(
        "s", F.pmod(F.xxhash64("rep", F.lit(9)), F.col("ks")).cast("int")).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    cols = ["component", "c", "s", "rep", "label"]
    meet = body.select(*cols).unionAll(guests.select(*cols))
    more = stored(_confirm(meet.join(rows.select("rep", "text"), "rep")
                           .select("component", "c", "s", "rep", "text", "label"),
                           ["component", "c", "s"], words, num, den), "links")
    if not more.limit(1).count():
        return parts
    return components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more))


def near_duplicates(documents: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every document: links join
    documents with ``den * |A & B| >= num * |A | B|`` on their shingle sets."""
    docs = stored(document_sets(documents, words), "sets")
    full = docs.where("digest IS NOT NULL")
    classes = stored(full.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = stored(full.join(classes.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"])
                  .select(F.col("doc_id").alias("rep"), "sketch").distinct(), "reps")
    edges = stored(candidate_edges(reps, num / den), "candidates")
    parts = links(documents, edges, words, num, den).select(F.col("node").alias("rep"), "component")
    named = stored(classes.join(parts, "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id")), "named")
    joined = docs.join(named, "digest", "left")
    return joined.select("doc_id", "n_shingles",
                         F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id") == F.col("component_id"))


def one_of_each(documents: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents, all columns, without near-duplicates: the one with the
    smallest id of each group stays, and a repeated row stays once."""
    kept = stored(near_duplicates(documents, words, num, den).where("kept").select(
        F.col("doc_id").alias("__llm_kept")).distinct(), "kept")
    left = documents.join(sized(kept), F.col("doc_id").cast("long") == F.col("__llm_kept"), "left_semi")
    if documents.groupBy("doc_id").count().where("count > 1").limit(1).count():
        left = left.withColumn("__llm_text", F.xxhash64("text")).dropDuplicates(["doc_id", "__llm_text"])
    return left.select(*documents.columns)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), 3, 85, 100)


#: Exact: sets of each class of equal sets meet through shared shingles.
OP4_SQL = r"""
WITH RECURSIVE tokens AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE doc_id IS NOT NULL
), sets AS MATERIALIZED (
  SELECT doc_id, CASE
      WHEN len(w) = 0 THEN []
      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1),
                                                  lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))
    END AS s
  FROM tokens
), classes AS MATERIALIZED (
  SELECT min(doc_id) AS rep, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), members AS MATERIALIZED (
  SELECT rep, n, unnest(s) AS shingle FROM classes
), shared AS (
  SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS m
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.rep <> b.rep
   AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM shared WHERE 100 * m >= 85 * (na + nb - m)
), reach AS (
  SELECT rep AS a, rep AS b FROM classes
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), component AS (
  SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles,
       coalesce(p.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(p.component_id, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON d.s = c.s LEFT JOIN component p ON c.rep = p.rep
"""
