"""Benchmark decontamination by latent semantic retrieval.

Benchmark passages and document windows are TF-IDF vectors over the words of
the benchmark, weighted by document frequencies over the whole corpus.  A
distributed randomised SVD of the passages' matrix, cut to half its rank or
less, gives a latent space into which both sides are projected.  A window is a
candidate for a passage where their cosine there is high and the window's
component along the passage is a fair share of the passage's own length (one
telling word points the same way as its passage but does not reach as far).
Candidates are verified word by word: the longest common subsequence must cover
enough of the passage, and paraphrases must also have the passage's answer (its
last words).

The benchmark is a stated query set.  Its words are counted in one reading of
the corpus; its retrieval rows are taken in blocks of ``block_rows``, a latent
space each.  A row that a cut space holds too little of (``held``) would be out
of reach there, so it goes to one more space among its like, until all are
held.  A passage longer than two windows is searched by window-sized pieces,
one retrieval row each, as one window holds too little of it; verification
always takes the whole passage.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import LETTERS, NUMBERS, SPACES, LatinCutter, PieceLists, hold, ship_package, slices, text_source, with_outputs


@dataclass(frozen=True)
class Rules:
    """Parameters of retrieval and verification."""

    window: int = 48  #: words a window, at half-window steps
    block_rows: int = 256  #: retrieval rows to a latent space at most
    rank_share: float = 0.5  #: its dimensions, as a share of its rows
    held: float = 0.3  #: share of a row's squared length that its space keeps at least
    cosine: float = 0.4  #: candidates in the latent space: at or above this ...
    reach: float = 0.25  #: ... and reaching so far along the passage, in its lengths
    common_share: float = 0.1  #: words in more documents than this are left out ...
    least_features: int = 12  #: ... but a retrieval row keeps its rarest this many
    lcs: float = 0.8  #: share of a passage's words for a copy
    lcs_paraphrase: float = 0.6  #: the same where the answer is there too
    answer_words: int = 6
    answer: float = 0.8  #: share of the answer's words, in order
    least_words: int = 8  #: shorter passages only match as a whole


FIELDS = "leaked boolean, leak_items array<long>, leak_lcs double, leak_cosine double"


def words_of(text: str | None) -> list[str]:
    """Lower-case words without the punctuation around them."""
    import re

    return re.findall(r"\w+", text.lower()) if text else []


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    at: dict[str, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & at.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def randomised_svd(rows: DataFrame, n_features: int, rank: int, *, rounds: int = 2, oversample: int = 8, seed: int = 7):
    """Right singular vectors (features, k) and singular values of the sparse
    matrix whose rows are ``index array<int>, value array<double>``.

    Subspace iteration: each round the tasks sum ``A'(A Q)`` over their rows and
    the driver orthonormalises; the driver and each task hold features x k
    numbers, both bounded by the block of passages.
    """
    import numpy as np

    k = min(rank + oversample, n_features)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_features, k)))
    spark = rows.sparkSession

    def apply(q):
        sent = spark.sparkContext.broadcast(q)

        def part(batches):
            import pyarrow as pa

            basis = sent.value
            total = np.zeros_like(basis)
            for b in batches:
                for i, v in zip(b.column("index").to_pylist(), b.column("value").to_pylist()):
                    if i:
                        i, v = np.array(i), np.array(v)
                        np.add.at(total, i, v[:, None] * (v @ basis[i])[None, :])
            at = np.flatnonzero(np.abs(total).sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([total[j].tobytes() for j in at], pa.binary())], names=["feature", "sums"])

        out = np.zeros_like(q)
        for r in rows.mapInArrow(part, "feature int, sums binary").toLocalIterator():
            out[r["feature"]] += np.frombuffer(r["sums"])
        sent.unpersist()
        return out

    for _ in range(rounds):
        q, _ = np.linalg.qr(apply(q))
    small = q.T @ apply(q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values)[:rank]
    best = best[values[best] > max(values.max(), 0) * 1e-10]
    return q @ vectors[:, best], np.sqrt(np.maximum(values[best], 0))


class WordNumbers(PieceLists):
    """Numbers of the words of texts in a vocabulary; -1 for any other word.
    Arrow looks them up; only words beyond Latin-1 become Python objects."""

    def __init__(self, numbers: dict[str, int]):
        import pyarrow as pa

        super().__init__(LatinCutter(SPACES, LETTERS + NUMBERS + "_"), 0)
        self.numbers, self.words = numbers, pa.array(numbers, pa.string())

    def lists(self, pieces, kinds):
        import numpy as np
        import pyarrow.compute as pc

        flat = pc.fill_null(pc.index_in(pieces, self.words), -1).to_numpy()
        starts, counts = np.arange(len(pieces), dtype=np.int32), (kinds == 1).astype(np.int32)
        more: list[int] = []
        for i in np.flatnonzero(kinds == LatinCutter.FOREIGN).tolist():
            own = [self.numbers.get(w, -1) for w in words_of(pieces[i].as_py())]
            starts[i], counts[i] = len(flat) + len(more), len(own)
            more += own
        return starts, counts, np.concatenate([flat, np.array(more, np.int32)])


def document_frequencies(docs: DataFrame, vocabulary: dict[str, int]):
    """In how many rows of ``docs`` (column ``text``) each word occurs, and how
    many rows there are; summed in the tasks, one row a word and task."""
    import numpy as np

    spark = docs.sparkSession
    sent, name = spark.sparkContext.broadcast(vocabulary), uuid.uuid4().hex

    def part(batches):
        import pyarrow as pa

        words = hold(("words", name), lambda: WordNumbers(sent.value))
        size = len(words.numbers)
        seen, n = np.zeros(size + 1, np.int64), 0
        for whole in batches:
            for b in slices(whole, 2 << 20, "text"):
                ids, ends = words.strung(b.column("text"))
                text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                once = np.unique((text * size + ids)[ids >= 0])
                seen[:-1] += np.bincount(once % size, minlength=size) if size else 0
                n += len(ends)
        seen[-1] = n
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], names=["word", "n"])

    out = np.zeros(len(vocabulary) + 1, np.int64)
    for r in docs.select("text").mapInArrow(part, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["word"]] = r["n"]
    return out[:-1], int(out[-1])


class Space:
    """Candidate search in one latent space: retrieval rows, each with the
    number of its passage, against windows of texts as word numbers."""

    def __init__(self, owners: list[int], latent, features: list[int], size: int, rows, rules: Rules):
        import numpy as np

        self.owners, self.rules = np.array(owners), rules
        #: Latent vector of one occurrence of each feature; a row of zeros for
        #: all other words, and the words' places in it.
        self.latent = np.vstack([latent, np.zeros((1, latent.shape[1]))]).astype(np.float32)
        self.place = np.full(size + 1, len(features), np.int32)
        self.place[features] = np.arange(len(features))
        self.lengths = np.linalg.norm(rows, axis=1).astype(np.float32)
        self.rows = (rows / self.lengths[:, None]).astype(np.float32)

    def candidates(self, ids, ends):
        """Rows (text, first word, passage, cosine) of the windows of texts
        strung together that come close.

        Windows are pairs of neighbouring half-window blocks of one text; a
        window without a feature has no vector and is no candidate.
        """
        import numpy as np

        half = self.rules.window // 2
        place = self.place[ids]  # -1, an unknown word, is the last place
        at = np.flatnonzero(place < len(self.latent) - 1)
        sizes = np.diff(ends, prepend=0)
        begins = ends - sizes
        text = np.searchsorted(ends, at, "right")
        # numbers of blocks, with a gap between texts so that no window spans two
        blocks = -(-sizes // half) + 1
        base = np.cumsum(blocks) - blocks
        key = base[text] + (at - begins[text]) // half
        firsts = np.flatnonzero(np.diff(key, prepend=-1))
        here = key[firsts]
        out = []
        step = 512  # blocks at a time: their words' vectors take some MB
        for i in range(0, len(here), step):
            # one block more, as the last window reaches into it
            some = here[i : i + step + 1]
            lo, hi = firsts[i], firsts[i + len(some)] if i + len(some) < len(firsts) else len(at)
            sums = np.add.reduceat(self.latent[place[at[lo:hi]]], firsts[i : i + len(some)] - lo, axis=0)
            some, sums = np.append(some, -1), np.vstack([sums, np.zeros((1, sums.shape[1]), np.float32)])
            mine = min(step, len(here) - i)
            # a window begins at each block, and at the empty one before a block
            alone = np.flatnonzero(np.diff(some[:mine], prepend=here[i - 1] if i else -1) > 1)
            after = np.where(np.append(some[1:], -1) == some + 1, np.arange(1, len(some) + 1), len(some) - 1)[:mine]
            vectors = np.concatenate([sums[:mine] + sums[after], sums[alone]])
            starts = np.concatenate([some[:mine], some[alone] - 1])
            norm = np.linalg.norm(vectors, axis=1)
            along = vectors @ self.rows.T
            w, row = np.nonzero((along >= self.rules.cosine * norm[:, None]) & (along >= self.rules.reach * self.lengths) & (along > 0))
            where = np.searchsorted(base, starts[w], "right") - 1
            # the empty block before a text's first one is the gap of the text
            # before; that window is the same as the one that begins one later
            word = (starts[w] - base[where]) * half
            real = word < sizes[where]
            out.append(np.column_stack([where, word, self.owners[row], along[w, row] / norm[w]])[real])
        return np.concatenate(out) if out else np.zeros((0, 4))


class Verifier:
    """Word by word checks of candidates, on word numbers."""

    def __init__(self, items: list[tuple[int, list[int]]], rules: Rules):
        self.items, self.rules = items, rules

    def share(self, words: list[int], start: int, item: int) -> float:
        """Share of the passage's words that the region around a window has in
        order, or 0 where the rules say no."""
        r, passage = self.rules, self.items[item][1]
        region = words[max(0, start - len(passage)) : start + r.window + len(passage)]
        share = common_subsequence(passage, region) / len(passage)
        if len(passage) < r.least_words:
            return share if share == 1.0 and consecutive(passage, region) else 0.0
        if share < r.lcs_paraphrase:
            return 0.0
        # the words must stand close together, not scattered over the region
        share = max(common_subsequence(passage, region[i : i + len(passage) * 5 // 4 + 2]) for i in range(0, max(1, len(region) - len(passage) + 1), max(1, len(passage) // 8))) / len(passage)
        if share >= r.lcs:
            return share
        answer = passage[-r.answer_words :]
        if share >= r.lcs_paraphrase and common_subsequence(answer, region) >= r.answer * len(answer):
            return share
        return 0.0

    def leaks(self, ids, ends, candidates) -> list[dict[int, tuple[float, float]]]:
        """For each text: item_id -> (share of its words, cosine) of the
        passages in it."""
        found: list[dict] = [{} for _ in ends]
        begins = [0, *ends.tolist()]
        text, words = -1, []
        close: dict[tuple[int, int, int], float] = {}
        for *place, cosine in candidates.tolist():
            key = tuple(map(int, place))
            close[key] = max(close.get(key, cosine), cosine)
        for (where, start, item), cosine in sorted(close.items()):
            if where != text:
                text, words = where, ids[begins[where] : begins[where + 1]].tolist()
            key, best = self.items[item][0], found[where]
            if key not in best or best[key][0] < 1.0:
                if share := self.share(words, start, item):
                    best[key] = max(best.get(key, (0.0, 0.0)), (share, cosine))
        return found


def consecutive(a: list[str], b: list[str]) -> bool:
    return any(b[i : i + len(a)] == a for i in range(len(b) - len(a) + 1))


def passages_of(benchmark: DataFrame, item_col: str, text_col: str) -> list[tuple[int, list[str]]]:
    rows = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t")).where("i is not null").dropDuplicates()
    out = [(r["i"], words_of(r["t"])) for r in rows.toLocalIterator()]
    return sorted((x for x in out if x[1]), key=lambda x: (x[0], x[1]))


def pieces_of(words: list[str], window: int) -> list[list[str]]:
    """A passage's retrieval rows: itself up to two windows of length, else
    window after window, the last one at its end."""
    if len(words) <= 2 * window:
        return [words]
    return [words[i : i + window] for i in [*range(0, len(words) - window, window), len(words) - window]]


def fit(docs: DataFrame, items: list[tuple[int, list[str]]], rules: Rules) -> tuple[dict[str, int], Verifier, list[Space]]:
    """The benchmark's vocabulary with weights over all of ``docs`` (column
    ``text``), its passages as word numbers, and the latent spaces."""
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
    seen, n = document_frequencies(docs, vocabulary)
    numbered = [(key, [vocabulary[w] for w in ws]) for key, ws in items]
    left = [(k, piece) for k, (_, ws) in enumerate(numbered) for piece in pieces_of(ws, rules.window)]
    spaces = []
    while left:
        later = []
        for i in range(0, len(left), rules.block_rows):
            space, missed = latent_space(docs.sparkSession, left[i : i + rules.block_rows], seen, n, rules)
            spaces.append(space)
            later += missed
        left = later
    return vocabulary, Verifier(numbered, rules), spaces


def latent_space(spark, pieces: list[tuple[int, list[int]]], seen, n: int, rules: Rules) -> tuple[Space, list[tuple[int, list[int]]]]:
    """A space of ``rank_share`` as many dimensions as rows, and the rows of
    which it holds less than ``held``; where that is all, it gets them all."""
    import numpy as np

    kept: set[int] = set()
    for _, ws in pieces:
        ranked = sorted(set(ws), key=lambda w: (seen[w], w))
        kept.update(ranked[: rules.least_features])
        kept.update(w for w in ranked if seen[w] <= rules.common_share * n)
    features = sorted(kept)
    place = {w: i for i, w in enumerate(features)}
    idf = np.log((n + 1) / (seen[features] + 1.0)) + 0.1
    matrix = np.zeros((len(pieces), len(features)))
    for k, (_, ws) in enumerate(pieces):
        for w in ws:
            if w in place:
                matrix[k, place[w]] += idf[place[w]]
    lengths = np.linalg.norm(matrix, axis=1)
    unit = matrix / lengths[:, None]
    table = spark.createDataFrame([(np.flatnonzero(r).tolist(), r[r != 0].tolist()) for r in unit], "index array<int>, value array<double>")
    rank = max(1, int(rules.rank_share * len(pieces)))
    vectors, _ = randomised_svd(table, len(features), rank)
    held = np.square(unit @ vectors).sum(axis=1) >= rules.held
    if not held.any():
        vectors, _ = randomised_svd(table, len(features), len(pieces))
        held[:] = True
    own = [p for p, h in zip(pieces, held) if h]
    space = Space([k for k, _ in own], idf[:, None] * vectors, features, len(seen), matrix[held] @ vectors, rules)
    return space, [p for p, h in zip(pieces, held) if not h]


def one_by_one(blocks: list, keep: int = 16):
    """Broadcast values in turn; beyond ``keep`` of them, each is dropped again
    and read anew from the executor's disk."""
    for block in blocks:
        yield block
        if len(blocks) > keep:
            del block._value


def annotate_leaks(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", passage_col: str = "text", rules: Rules | None = None) -> DataFrame:
    """Every row of ``docs`` with the columns of :data:`FIELDS`.

    ``leak_items`` lists the ids of the benchmark passages in the text,
    ascending; ``leak_lcs`` and ``leak_cosine`` (in the latent space) are those
    of the best.  Null and empty texts, and an empty benchmark, leak nothing.
    Passages with null or wordless text are never found.  No shuffle: a document
    is judged whole, in its own row; the corpus is read once for the word
    frequencies and once for the search.  Every task has the benchmark's words
    and goes through the latent spaces one after the other, holding one.
    """
    rules = rules or Rules()
    spark = docs.sparkSession
    ship_package(spark)
    items = passages_of(benchmark, item_col, passage_col)
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    vocabulary, verifier, spaces = fit(texts, items, rules) if items else ({}, None, [])
    sent, name = spark.sparkContext.broadcast((vocabulary, verifier)), uuid.uuid4().hex
    blocks = [spark.sparkContext.broadcast(space) for space in spaces]
    schema = with_outputs(docs.schema, FIELDS)
    names = [f.name for f in schema]
    rows, held = text_source(docs, text_col)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        words, verifier = hold(("leaks", name), lambda: (WordNumbers(sent.value[0]), sent.value[1]))
        target = to_arrow_schema(schema)
        for batch in (b for whole in batches for b in slices(whole, 2 << 20, held)):
            ids, ends = words.strung(batch.column(held))
            near = [block.value.candidates(ids, ends) for block in one_by_one(blocks)]
            found = verifier.leaks(ids, ends, np.concatenate(near)) if near else [{} for _ in ends]
            best = [max(f.values(), default=(0.0, 0.0)) for f in found]
            new = {
                "leaked": pa.array([bool(f) for f in found], pa.bool_()),
                "leak_items": pa.array([sorted(f) for f in found], target.field("leak_items").type),
                "leak_lcs": pa.array([b[0] for b in best], pa.float64()),
                "leak_cosine": pa.array([b[1] for b in best], pa.float64()),
            }
            yield pa.RecordBatch.from_arrays([new[k] if k in new else batch.column(k) for k in names], schema=target)

    return rows.mapInArrow(run, schema)
