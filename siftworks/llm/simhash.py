"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most 4 bits exactly when some value is
within 2 bits of both.  So every distinct fingerprint emits its 2,081 variants
within 2 bits, and fingerprints with an equal variant are linked.

Variants are dealt by a linear hash, the exclusive-or of their 64 bits folded
to ``r`` bits: the variants of one fingerprint fall into 1 + r + r(r-1)/2
folds, so it travels once to each and its variants are expanded there, never on
the wire.  Near copies differ in random bits, so their folds differ too: even a
group with a third of all rows spreads over the folds.  In a fold,
fingerprints that share a variant are linked to the least of them, a star and
not all pairs, since any two of them are linked by the same variant.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import hold, materialise, ship_package, slices, text_source, with_outputs
from siftworks.llm.components import connected_components

BITS = 64
RADIUS = 4


def fingerprint_of(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned SimHash of a text; no word gives zero."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    hash_ = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash_(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends + 1 - sizes)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    values = np.fromiter((hash_(joined[s:e], seed) for s, e in zip(starts, ends)), np.uint64, len(starts))
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(values), 4096):
        part = values[i : i + 4096]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    bits = np.packbits(2 * votes > len(values), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed long) of every whole text; null texts give zero."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return annotate_fingerprints(rows, keep=["doc_id"])


def annotate_fingerprints(df: DataFrame, *, text_col: str = "text", fp_col: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``df`` (its columns ``keep``, else all) with ``fp_col``, the
    signed fingerprint of the whole text; a column of that name is replaced."""
    ship_package(df.sparkSession)
    rows, held = text_source(df, text_col)
    schema = with_outputs(df.select(*[F.col(f"`{c}`") for c in keep or df.columns]).schema, f"{fp_col} long")
    names = [f.name for f in schema]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hold("nothing")
        for whole in batches:
            for batch in slices(whole, 8 << 20, held):
                got = np.array([fingerprint_of(x.as_py()) for x in batch.column(held)], np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(got.view(np.int64)) if k == fp_col else batch.column(k) for k in names], names=names)

    return rows.mapInArrow(run, schema)


def folds_for(n: int) -> int:
    """Bits of the fold for ``n`` fingerprints: some dozens home in each fold
    up to 11 bits, whose 2,048 folds even out over many tasks, and about a
    thousand beyond that."""
    return min(24, max(6, min(11, (n // 24).bit_length()), (n >> 10).bit_length()))


def masks_by_fold(r: int, reach: int) -> list[tuple[int, list[int]]]:
    """(change of the fold, masks) over all masks of at most ``reach`` bits;
    bit i of a value counts in bit i mod r of its fold."""
    out: dict[int, list[int]] = {}
    for k in range(reach + 1):
        for bits in combinations(range(BITS), k):
            fold = 0
            for b in bits:
                fold ^= 1 << (b % r)
            out.setdefault(fold, []).append(sum(1 << b for b in bits))
    return sorted(out.items())


def stars(values, groups, masks: list[list[int]]):
    """Links among the fingerprints of one fold: (first, other) arrays.

    ``groups`` says which change of the fold brought a fingerprint here, hence
    which of its variants lie here.  Variants are sorted, runs of equal ones
    link their members to the first, and links are merged to components.
    """
    import numpy as np

    order = np.argsort(values)
    values, groups = values[order], groups[order]
    parts, who = [], []
    for g in np.unique(groups):
        at = np.flatnonzero(groups == g)
        parts.append((values[at][:, None] ^ np.array(masks[g], np.uint64)[None, :]).ravel())
        who.append(np.repeat(at.astype(np.int32), len(masks[g])))
    variants, who = np.concatenate(parts), np.concatenate(who)
    order = np.argsort(variants)
    variants, who = variants[order], who[order]
    same = np.flatnonzero(variants[1:] == variants[:-1])
    if not len(same):
        return values[:0], values[:0]
    a, b = who[same], who[same + 1]  # neighbours of a run are linked: a chain is a star's equal
    near = np.bitwise_count(values[a] ^ values[b]) <= RADIUS  # every colliding pair is verified
    a, b = a[near], b[near]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = np.flatnonzero(label != np.arange(len(label)))
    return values[label[linked]], values[linked]


def link_fingerprints(nodes: DataFrame, n: int) -> DataFrame:
    """Links u, v among the fingerprints of ``nodes`` (fp, distinct): enough of
    them that those within the radius are connected, and none between others."""
    ship_package(nodes.sparkSession)
    r = folds_for(n)
    table = masks_by_fold(r, RADIUS // 2)
    changes, masks = [c for c, _ in table], [m for _, m in table]
    fold = F.lit(0).cast("long")
    for k in range(0, BITS, r):
        fold = fold.bitwiseXOR(F.shiftrightunsigned("fp", k))
    fold = fold.bitwiseAND(F.lit((1 << r) - 1).cast("long"))

    def link(keys, table_):
        import numpy as np
        import pyarrow as pa

        u, v = stars(
            table_.column("fp").to_numpy().view(np.uint64),
            table_.column("g").to_numpy(),
            masks,
        )
        return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    dealt = nodes.select("fp", F.posexplode(F.array(*[F.lit(c).cast("long") for c in changes])).alias("g", "change"), fold.alias("own"))
    dealt = dealt.select("fp", "g", F.col("own").bitwiseXOR(F.col("change")).alias("fold"))
    return dealt.groupBy("fold").applyInArrow(link, "u long, v long").distinct()


def groups(rows: DataFrame) -> DataFrame:
    """One row a distinct fingerprint of ``rows`` (doc_id, fp): fp, doc_id (the
    least of its rows), component (its group's least fingerprint) and
    component_id (its group's least id).  ``rows`` is read twice."""
    nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprint-nodes")
    found = connected_components(link_fingerprints(nodes.select("fp"), nodes.count()))
    named = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = materialise(named, "fingerprint-components")
    return named.join(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component")


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits), component_id, for every row.

    ``component_id`` is the least id reachable over links of at most 4 bits,
    the row's own included.  Equal fingerprints, so all texts without words,
    are one node.  Rows with a null id take part; a component of such rows
    only has a null id.
    """
    rows = materialise(fingerprints(df, id_col=id_col, text_col=text_col), "fingerprints")
    named = groups(rows).select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every near-duplicate group, with all columns of ``df``: that
    of the least id, or of the least fingerprint among rows of equal ids.

    Rows that share id and fingerprint are one document: the least by text,
    then by the other columns in order, stays (columns must be orderable).
    Rows that share an id but belong to unlike groups are each one's.  A group
    of null ids only is represented by a row with a null id.  Copies are
    combined before the one shuffle of the texts, so no group is gathered.
    """
    columns, key = df.columns, f"`{id_col}`"
    rest = sorted((c for c in columns if c != id_col), key=lambda c: c != text_col)
    rows = materialise(annotate_fingerprints(df, text_col=text_col, fp_col="__fp"), "marked-texts")
    named = groups(rows.select(F.col(key).cast("long").alias("doc_id"), F.col("__fp").alias("fp")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("key"), "fp")).alias("first")
    chosen = named.groupBy("component").agg(first).select(F.col("first.none").alias("__none"), F.col("first.key").alias("__key"), F.col("first.fp").alias("__fp"))
    # plain keys on both sides, so the join finds the texts where the grouping put them
    keys = [F.col(key).isNull().alias("__none"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("__key"), "__fp"]
    one = rows.groupBy(*keys).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest], key)).alias("__row"))
    kept = one.join(chosen, ["__none", "__key", "__fp"], "left_semi")
    return kept.select(*[F.col("__row")[c].alias(c) for c in columns])
