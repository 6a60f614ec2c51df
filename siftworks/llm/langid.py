"""Language identification by segmentation-marginalised unigrams.

For each language, the pieces of a fixed public vocabulary have probabilities;
a word's probability is the sum over all its segmentations into pieces (the
forward algorithm), a text's the product over its words.  Probabilities are
fitted by expectation-maximisation on labelled rows; expected counts are summed
on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import LETTERS, SPACES, LatinCutter, PieceLists, hold, materialise, ship_package, slices, text_of

MARK = "▁"
#: Probability of a character that no one-character piece covers.
UNKNOWN_CHAR = 1e-7
#: Piece probabilities never fall below this.
FLOOR = 1e-8
MAX_WORD = 40
#: Labelled rows a language that the fit reads, about; the rest is not needed.
FIT_ROWS = 600


def load_pieces(model_path: str) -> list[str]:
    """Pieces of letters, with or without the word mark, in vocabulary order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return list(dict.fromkeys(p for p in pieces if p != MARK and p.removeprefix(MARK).isalpha() and p.lower() == p))


class Segmenter:
    """Forward and backward sums over the segmentations of words.

    ``table`` has a row a piece and a column a language.  Words of one length
    are handled together; words longer than ``MAX_WORD`` letters are cut there.
    """

    def __init__(self, pieces: list[str], table):
        import numpy as np

        self.pieces = pieces
        self.sizes = np.array([*map(len, pieces), 1])
        #: One more row for unknown characters.
        self.table = np.vstack([table, np.full((1, table.shape[1]), UNKNOWN_CHAR)])
        self.unknown = len(pieces)
        self.automaton = None  # built where it is used: it does not travel

    def matches(self, words: list[str]):
        """(end, length, rows, pieces) lists of all matches in equally long
        words; the mark counts as their first character.  One automaton finds
        all pieces in the words strung together."""
        import ahocorasick
        import numpy as np

        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for i, piece in enumerate(self.pieces):
                self.automaton.add_word(piece, i)
            self.automaton.make_automaton()
        n, count = len(words[0]), len(words)
        found = list(self.automaton.iter("\n".join(words))) if self.pieces else []
        at, ids = np.array(found, np.int64).reshape(-1, 2).T
        rows, ends = at // (n + 1), at % (n + 1) + 1
        covered = np.zeros((count, n), bool)
        single = self.sizes[ids] == 1
        covered[rows[single], ends[single] - 1] = True
        row, place = np.nonzero(~covered)
        rows, ends, ids = np.concatenate([rows, row]), np.concatenate([ends, place + 1]), np.concatenate([ids, np.full(len(row), self.unknown)])
        sizes = self.sizes[ids]
        order = np.lexsort((rows, sizes, ends))
        rows, ends, ids, sizes = rows[order], ends[order], ids[order], sizes[order]
        cuts = np.flatnonzero(np.diff(ends * (n + 1) + sizes, prepend=-1))
        return [(int(ends[i]), int(sizes[i]), rows[i:j], ids[i:j]) for i, j in zip(cuts, [*cuts[1:], len(rows)])]

    def forward(self, words: list[str], matches):
        import numpy as np

        alpha = np.zeros((len(words[0]) + 1, len(words), self.table.shape[1]))
        alpha[0] = 1.0
        for end, size, rows, ids in matches:
            alpha[end, rows] += alpha[end - size, rows] * self.table[ids]
        return alpha

    def log_probabilities(self, words: list[str]):
        """Matrix (word, language) of natural logs."""
        import numpy as np

        out = np.empty((len(words), self.table.shape[1]))
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for at in by_length.values():
            group = [words[i] for i in at]
            out[at] = np.log(np.maximum(self.forward(group, self.matches(group))[-1], 1e-300))
        return out

    def expected(self, words: list[str], weights):
        """Expected piece counts (piece, language) of words with weights
        (word, language)."""
        import numpy as np

        out = np.zeros_like(self.table)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for at in by_length.values():
            group = [words[i] for i in at]
            matches = self.matches(group)
            alpha = self.forward(group, matches)
            beta = np.zeros_like(alpha)
            beta[-1] = 1.0
            for end, size, rows, ids in sorted(matches, key=lambda m: -m[0]):
                beta[end - size, rows] += beta[end, rows] * self.table[ids]
            scale = weights[at] / np.maximum(alpha[-1], 1e-300)
            for end, size, rows, ids in matches:
                np.add.at(out, ids, alpha[end - size, rows] * self.table[ids] * beta[end, rows] * scale[rows])
        return out[:-1]


def words_of(text: str) -> list[str]:
    """Marked, lower-case runs of letters; those beyond MAX_WORD are cut."""
    import re

    out = []
    for run in re.findall(r"[^\W\d_]+", text.lower()):
        # the pattern's runs hold numbers like a half, too, which are no letters
        for w in (run,) if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split():
            out += [MARK + w[i : i + MAX_WORD - 1] for i in range(0, len(w), MAX_WORD - 1)]
    return out


def fit(df: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_language: int = FIT_ROWS, rounds: int = 3) -> tuple[list[str], list[str], object]:
    """(languages, pieces, table) from labelled rows.

    Rows without a language or a text are left out.  About
    ``rows_per_language`` rows of each language are read, chosen by a hash of
    the id, so reruns agree; the fit's driver data are the table, pieces by
    languages.  No labelled row: no languages.
    """
    import numpy as np

    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("lang is not null and text is not null")
    have = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(have, key=lambda x: x.encode())
    pieces = load_pieces(model_path)
    if not languages:
        return [], pieces, np.zeros((len(pieces), 0))
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, rows_per_language / have[k])))])
    chosen = rows.where(F.shiftrightunsigned(F.xxhash64("id"), 1) / float(2**63) <= F.element_at(share, F.col("lang")))

    def count(batches):
        import pyarrow as pa
        from collections import Counter

        seen: Counter = Counter()
        for b in batches:
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                seen.update((lang, w) for w in words_of(text))
        keys = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64())], names=["lang", "word", "n"])

    words = chosen.select("text", "lang").mapInArrow(count, "lang string, word string, n long").groupBy("word").agg(*[F.sum(F.when(F.col("lang") == k, F.col("n")).otherwise(0)).cast("double").alias(f"n{i}") for i, k in enumerate(languages)])
    words = materialise(words, "langid-words")
    lengths = np.array([len(p) for p in pieces], float)
    start = np.exp(-2.0 * lengths)  # short pieces first; EM moves the mass to the long ones
    table = np.repeat((start / start.sum())[:, None], len(languages), axis=1)
    names = [f"n{i}" for i in range(len(languages))]
    for _ in range(rounds):
        segmenter = Segmenter(pieces, table)

        def expect(batches, segmenter=segmenter):
            import pyarrow as pa

            total = np.zeros((len(segmenter.table) - 1, len(names)))
            for b in batches:
                weights = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)
                listed = b.column("word").to_pylist()
                for i in range(0, len(listed), 4000):
                    total += segmenter.expected(listed[i : i + 4000], weights[i : i + 4000])
            at = np.flatnonzero(total.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *[pa.array(total[at, k]) for k in range(len(names))]], names=["piece", *names])

        sums = words.mapInArrow(expect, "piece int, " + ", ".join(f"{n} double" for n in names)).groupBy("piece").agg(*[F.sum(n).alias(n) for n in names])
        got = np.zeros_like(table)
        for r in sums.collect():  # pieces of the vocabulary at most
            got[r["piece"]] = [r[n] for n in names]
        smooth = got + 0.01
        table = np.maximum(smooth / smooth.sum(axis=0), FLOOR)
    return languages, pieces, np.round(table, 15)


class Scorer(PieceLists):
    """Scores texts by the log-probabilities of their distinct runs of letters,
    a row each; a word with a character beyond Latin-1 is one row."""

    def __init__(self, languages, pieces, table, limit: int = 64 << 20):
        self.languages = languages
        self.segmenter = Segmenter(pieces, table)
        super().__init__(LatinCutter(SPACES, LETTERS), limit)

    def clear(self) -> None:
        import numpy as np

        super().clear()
        self.logs, self.rows = np.zeros((1024, len(self.languages))), 0
        self.fresh: list[list[str]] = []

    def make(self, piece: str) -> list[int]:
        runs = words_of(piece)
        if not runs:
            return []
        self.fresh.append(runs)
        self.held += 8 * len(self.languages)
        return [self.rows + len(self.fresh) - 1]

    def learn(self) -> None:
        """The rows of the words that are new."""
        import numpy as np

        while len(self.logs) < self.rows + len(self.fresh):
            self.logs = np.concatenate([self.logs, np.zeros_like(self.logs)])
        for i in range(0, len(self.fresh), 20_000):
            part = self.fresh[i : i + 20_000]
            firsts = np.cumsum([0, *map(len, part[:-1])])
            self.logs[self.rows : self.rows + len(part)] = np.add.reduceat(self.segmenter.log_probabilities([r for runs in part for r in runs]), firsts, axis=0)
            self.rows += len(part)
        self.fresh = []

    def score(self, texts) -> tuple[list[str], list[float]]:
        """Language and score of each text of an Arrow string array."""
        import numpy as np

        ids, ends = self.strung(texts)
        self.learn()
        names, scores = ["und"] * len(ends), np.zeros(len(ends))
        sizes = np.diff(ends, prepend=0)
        some = np.flatnonzero(sizes)
        if self.languages and len(some):
            total = np.add.reduceat(self.logs[ids], (ends - sizes)[some], axis=0)
            best = total.argmax(axis=1)  # ties: the first language in code-point order
            scores[some] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            for i, k in zip(some.tolist(), best.tolist()):
                names[i] = self.languages[k]
        return names, scores.tolist()


def predict(df: DataFrame, model: tuple, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every whole text; only the text is looked at.

    ``score`` is the posterior of the predicted language under equal priors.
    A null text, or one without a letter (numbers such as a half are none), is
    ``und`` with score 0.
    """
    import hashlib

    spark = df.sparkSession
    ship_package(spark)
    languages, pieces, table = model
    key = hashlib.sha256(repr((languages, len(pieces))).encode() + table.tobytes()).hexdigest()
    sent = spark.sparkContext.broadcast((languages, pieces, table))  # pieces by languages: fixed by the vocabulary

    def run(batches):
        import pyarrow as pa

        scorer = hold(("scorer", key), lambda: Scorer(*sent.value))
        for whole in batches:
            for batch in slices(whole, 2 << 20, "text"):
                names, scores = scorer.score(batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
