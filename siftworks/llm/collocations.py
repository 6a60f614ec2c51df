"""Phrase collocations from vertical positional inverted lists.

Texts are cut into blocks of one language.  Within a block a phrase is the
ascending list of positions where it begins; lists of phrases of k words come
from those of k - 1 words by a merge join with the postings of the word after
them, and a list's length is the phrase's exact frequency in the block.  Only
frequencies travel: each level's (phrase, block, frequency) rows are summed over
the blocks, and each block hears which of its own phrases are frequent in their
language; only those are extended.  No level holds a vocabulary on the driver or
in a broadcast.

Null texts are empty, a null language is ``und``.  Repeated rows count as often
as they stand.  Other columns are not read.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.llm.common import materialise, ship_package

#: Pieces end at these bytes; words end at a space or a tab.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLOCK = "block long, lang string, words array<string>, counts array<long>, codes binary"
#: A block's phrases of one bucket, in packed columns; ``begin`` is the number of
#: the first.
FOUND = "bucket long, block long, begin long, first binary, last binary, counts binary"
#: What a block hears of a bucket's phrases, and in one row a bucket (block null)
#: the frequent phrases themselves.
HEARD = "block long, idx binary, ids binary, id array<long>, first array<long>, last array<long>, f array<long>"
#: Blocks of a task are numbered within these bits of a block's number, its
#: words and phrases within 32 bits of a phrase's.
BLOCK_BITS = 12


class Numbering(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self) - 1  # the mark between pieces is -1 and counts for one
        return at


def pack(numbers) -> bytes:
    """Whole numbers as zstd-compressed planes of their bytes."""
    import numpy as np
    import pyarrow as pa

    width = numbers.dtype.itemsize
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(raw: bytes):
    import numpy as np
    import pyarrow as pa

    width, n = raw[0], int.from_bytes(raw[1:9], "little")
    planes = np.frombuffer(pa.decompress(raw[9:], width * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<i{width}").ravel()


def spans(raw: bytes, most: int):
    """A text in spans of about ``most`` bytes that end at a space."""
    begin = 0
    while len(raw) - begin > most:
        end = raw.rfind(b" ", begin, begin + most) + 1 or raw.find(b" ", begin + most) + 1
        if not end:
            break
        yield raw[begin:end]
        begin = end
    yield raw[begin:]


def cut_blocks(batches, block_words: int, span_bytes: int = 4 << 20):
    """Rows of BLOCK from batches of (lang, text); a block ends with a text."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    table = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + PIECE_ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(PIECE_ENDS))
    open_: dict[str, tuple[Numbering, list, list]] = {}
    made = 0

    def closed(lang: str):
        nonlocal made
        numbers, parts, _ = open_.pop(lang)
        codes = np.concatenate(parts)
        counts = np.bincount(codes[codes >= 0], minlength=len(numbers) - 1)
        if made >> BLOCK_BITS:
            raise ValueError(f"a task has more than {1 << BLOCK_BITS} blocks")
        at = TaskContext.get().partitionId() << BLOCK_BITS | made
        made += 1
        words = [w.decode("utf-8", "replace") for w in numbers if w != b"\n"]
        return pa.RecordBatch.from_pydict({"block": pa.array([at], pa.int64()), "lang": [lang], "words": pa.array([words], pa.list_(pa.string())), "counts": pa.array([counts.tolist()], pa.list_(pa.int64())), "codes": pa.array([pack(codes)], pa.binary())})

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if lang not in open_:
                open_[lang] = (Numbering({b"\n": -1}), [], [0])
            numbers, parts, held = open_[lang]
            raw = text.as_py() or ""
            for part in spans(raw.encode("utf-8", "replace").translate(table), span_bytes):
                tokens = [t for t in part.replace(b"\n", b" \n ").split(b" ") if t]
                parts.append(np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens)))
                held[0] += len(tokens)
            parts.append(np.full(1, -1, np.int32))
            if held[0] >= block_words:
                yield closed(lang)
    for lang in list(open_):
        yield closed(lang)


def frequent_only(which, at, kept):
    """Occurrences of the phrases in ``kept``, which are numbered anew."""
    import numpy as np

    new = np.full(int(max(which.max(initial=-1), kept.max(initial=-1))) + 1, -1, np.int64)
    new[kept] = np.arange(len(kept))
    which = new[which]
    return which[which >= 0], at[which >= 0]


def extend(lists, postings, k: int):
    """Lists of phrases of ``k`` words: (first, last) of each phrase, and its
    occurrences ordered by place.

    ``lists`` are the occurrences (phrase, place) of the frequent phrases of k-1
    words and ``postings`` those of the frequent words, both by place.  A phrase
    at p is extended by the word at p + k - 1, a merge of both lists, where the
    rest of the longer phrase, at p + 1, is frequent too.
    """
    import numpy as np

    which, at = lists
    words, places = postings
    rest = np.searchsorted(at, at + 1)
    good = rest < len(at)
    good[good] = at[rest[good]] == at[good] + 1
    first, begin = which[good], at[good]
    after = np.searchsorted(places, begin + k - 1)
    met = after < len(places)
    met[met] = places[after[met]] == begin[met] + k - 1
    first, begin, last = first[met], begin[met], words[after[met]]
    width = int(words.max(initial=0)) + 1
    keys, which, counts = np.unique(first * width + last, return_inverse=True, return_counts=True)
    return keys // width, keys % width, counts, (which, begin)


def dealt(first, last, buckets: int):
    """The order in which a block numbers its phrases: by bucket, which is a
    hash of (first, last), then by these; and their buckets in that order."""
    import numpy as np

    mixed = (first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (last.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed ^= mixed >> np.uint64(29)
    bucket = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33)).astype(np.int64) % buckets
    order = np.lexsort((last, first, bucket))
    return order, bucket[order]


def extended(batches, k: int, buckets: int):
    """Rows of FOUND: phrases of ``k`` words of each block with their frequency
    there.  ``heard1`` to ``heard{k-1}`` are the block's frequent phrases of
    fewer words, by their numbers in it, and their ids."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for i in range(batch.num_rows):
            codes = unpack(batch.column("codes")[i].as_py())
            heard = []
            for n in range(1, k):
                parts = batch.column(f"heard{n}")[i].as_py() or []
                idx = np.concatenate([np.zeros(0, np.int64)] + [unpack(x["idx"]) for x in parts])
                ids = np.concatenate([np.zeros(0, np.int64)] + [unpack(x["ids"]) for x in parts])
                by = np.argsort(idx)
                heard.append((idx[by], ids[by]))
            if not all(len(idx) for idx, _ in heard):
                continue
            at = np.flatnonzero(codes >= 0)
            (kept, word_ids) = heard[0]
            postings = lists = frequent_only(codes[at].astype(np.int64), at, kept)
            ids = word_ids
            for n in range(2, k + 1):
                first, last, counts, lists = extend(lists, postings, n)
                first, last = ids[first], word_ids[last]
                order, bucket = dealt(first, last, buckets)
                if n < k:
                    kept, ids = heard[n - 1]
                    lists = frequent_only(*lists, order[kept])
            first, last, counts = first[order], last[order], counts[order]
            begins = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(begins[1:], len(bucket))
            block = np.full(len(begins), batch.column("block")[i].as_py(), np.int64)
            packed = [[pack(x[b:e]) for b, e in zip(begins, ends)] for x in (first, last, counts.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket[begins], block, begins)] + [pa.array(x, pa.binary()) for x in packed], ["bucket", "block", "begin", "first", "last", "counts"])


def merged(table, least: int):
    """Rows of HEARD of one bucket: frequencies summed over its blocks.  A
    frequent phrase's id is its number in the first block where it stands."""
    import numpy as np
    import pyarrow as pa

    rows = table.select(["block", "begin", "first", "last", "counts"]).to_pylist()
    first, last, counts = (np.concatenate([unpack(r[c]) for r in rows]) for c in ("first", "last", "counts"))
    sizes = [int.from_bytes(r["first"][1:9], "little") for r in rows]
    row = np.repeat(np.arange(len(rows)), sizes)
    idx = np.concatenate([r["begin"] + np.arange(n) for r, n in zip(rows, sizes)])
    own = (np.array([r["block"] for r in rows], np.int64)[row] << 32) + idx
    order = np.lexsort((own, last, first))
    first, last = first[order], last[order]
    new = np.ones(len(order), bool)
    new[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    at = np.flatnonzero(new)
    f = np.add.reduceat(counts[order].astype(np.int64), at)
    lead = own[order][at]
    often = f >= least
    ids = np.empty(len(order), np.int64)
    ids[order] = np.repeat(np.where(often, lead, -1), np.diff(np.append(at, len(order))))
    told, ends = [], np.cumsum(sizes)
    for r, end, n in zip(rows, ends, sizes):
        mine = slice(end - n, end)
        good = ids[mine] >= 0
        if good.any():
            told.append((r["block"], pack(idx[mine][good]), pack(ids[mine][good])))
    nothing = [None] * len(told)
    columns = [[t[j] for t in told] + [None] for j in range(3)] + [nothing + [x[often].tolist()] for x in (lead, first[at], last[at], f)]
    kinds = [pa.int64(), pa.binary(), pa.binary()] + [pa.list_(pa.int64())] * 4
    return pa.Table.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names=["block", "idx", "ids", "id", "first", "last", "f"])


def packed_numbers(batches):
    """A block's frequent words as packed columns."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        rows = [[pack(batch.column(c)[i].values.to_numpy().astype(np.int64)) for i in range(batch.num_rows)] for c in ("idx", "ids")]
        yield pa.RecordBatch.from_arrays([batch.column("block")] + [pa.array(x, pa.binary()) for x in rows], ["block", "idx", "ids"])


def frequent_phrases(df: DataFrame, *, lang_col: str = "lang", text_col: str = "text", least: int = 30, longest: int = 4, block_words: int = 1 << 20, bucket_words: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of up to ``longest`` words that
    stand ``least`` times or more, and (lang, n), the words of a language.

    A task holds a block of about ``block_words`` words, and of the phrases of
    each length a bucket of as many as ``bucket_words`` words have.
    """
    spark = df.sparkSession
    ship_package(spark)
    texts = df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    blocks = materialise(texts.mapInArrow(partial(cut_blocks, block_words=block_words), BLOCK), "phrase-blocks")
    totals = blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))

    words = blocks.select("lang", F.shiftleft("block", 32).alias("at"), F.posexplode(F.arrays_zip("words", "counts")).alias("idx", "x")).select("lang", (F.col("at") + F.col("idx")).alias("own"), F.col("x.words").alias("phrase"), F.col("x.counts").alias("c"))
    same = Window.partitionBy("lang", "phrase")  # a row a block
    words = words.withColumn("f", F.sum("c").over(same)).withColumn("id", F.min("own").over(same)).where(F.col("f") >= least)
    heard = materialise(words.select("own", "id", "f", F.when(F.col("own") == F.col("id"), F.struct("lang", "phrase")).alias("lead")), "phrases-1")
    named = [heard.where("lead IS NOT NULL").select("id", "lead.lang", "lead.phrase", "f")]
    told = heard.groupBy(F.shiftright("own", 32).alias("block")).agg(F.collect_list(F.struct(F.col("own").bitwiseAND(0xFFFFFFFF).alias("idx"), "id")).alias("x"))
    told = told.select("block", F.col("x.idx").alias("idx"), F.col("x.id").alias("ids")).mapInArrow(packed_numbers, "block long, idx binary, ids binary")
    known = materialise(blocks.select("block", "codes").join(told.select("block", F.array(F.struct("idx", "ids")).alias("heard1")), "block"), "phrase-blocks-1")
    n_words = blocks.agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    buckets = max(1, n_words // bucket_words)
    for k in range(2, longest + 1):
        found = known.mapInArrow(partial(extended, k=k, buckets=buckets), FOUND)
        heard = materialise(found.groupBy("bucket").applyInArrow(lambda t: merged(t, least), HEARD), f"phrases-{k}")
        told = heard.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("idx", "ids")).alias(f"heard{k}"))
        known = known.join(told, "block")
        phrases = heard.where("block IS NULL").select(F.explode(F.arrays_zip("id", "first", "last", "f")).alias("x")).select("x.*")
        front, word = named[-1].select(F.col("id").alias("first"), "lang", F.col("phrase").alias("front")), named[0].select(F.col("id").alias("last"), F.col("phrase").alias("word"))
        made = phrases.join(front, "first").join(word, "last")
        named.append(materialise(made.select("id", "lang", F.concat_ws(" ", "front", "word").alias("phrase"), "f"), f"named-{k}"))
    all_ = [x.select("lang", F.lit(k).alias("size"), "phrase", "f") for k, x in enumerate(named, 1)]
    out = all_[0]
    for x in all_[1:]:
        out = out.unionByName(x)
    return out, totals


def words_of(phrase: Column, begin: Column, n: Column) -> Column:
    """Words of a phrase from number ``begin`` (from 1) on."""
    return F.array_join(F.slice(F.split(phrase, " ", -1), begin, n), " ")


def collocations(df: DataFrame, *, lang_col: str = "lang", text_col: str = "text", least: int = 30, longest: int = 4, top: int = 2000, share: tuple[int, int] = (80, 100), block_words: int = 1 << 20) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of two words
    or more of each language by score, then a, then phrase.

    A phrase of frequency a is cut where 2,000,000 a / (l + r), rounded down, is
    least, l and r being its parts' frequencies (ties: the first cut).  Phrases
    inside a longer frequent one that stands in at least ``share`` of their
    places are left out.  All comparisons are in whole numbers.
    """
    phrases, totals = frequent_phrases(df, lang_col=lang_col, text_col=text_col, least=least, longest=longest, block_words=block_words)
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part"))
    candidates = phrases.where("size > 1")

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("left", words_of(F.col("phrase"), F.lit(1), F.col("k"))).withColumn("right", words_of(F.col("phrase"), F.col("k") + 1, F.col("size")))
    cuts = cuts.join(parts.select("lang", F.col("part").alias("left"), F.col("of_part").alias("l")), ["lang", "left"]).join(parts.select("lang", F.col("part").alias("right"), F.col("of_part").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr("CAST(2000000 AS DECIMAL(38, 0)) * CAST(f AS DECIMAL(20, 0)) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("f").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.where("size > 2").select("lang", "phrase", "size", F.col("f").alias("above"), F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("begin"))
    inner = inner.groupBy("lang", words_of(F.col("phrase"), F.col("begin"), F.col("m")).alias("phrase")).agg(F.max("above").alias("above"))
    whole = scored.join(inner, ["lang", "phrase"], "left").where(f"above IS NULL OR CAST({share[1]} AS DECIMAL(20, 0)) * CAST(above AS DECIMAL(18, 0)) < CAST({share[0]} AS DECIMAL(20, 0)) * CAST(a AS DECIMAL(18, 0))")

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = whole.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # totals have one row a language, as many as the result has languages at most
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
