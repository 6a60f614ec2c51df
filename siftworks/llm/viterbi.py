"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists, end by end, every vocabulary piece that
matches; the dynamic programme keeps for each position the best score and the
number of pieces that reach it, no back pointers and no ids.  It follows the
tokenizer's rules exactly: candidates for an end come in order of their start,
a later one wins only with a strictly greater score; a character that no
one-character piece covers may stand as an unknown, ten below the lowest score;
unknown characters count one token a UTF-8 byte.

White space is marked as the tokenizer marks it: every space is a word mark
that begins a new word, and a text that does not begin with one gets one.  No
piece crosses the start of a word, so counts are per word and are cached.  This
is the pre-tokenizer ``Metaspace(split=True)``: the vocabulary's pieces of
several marks never match, so a run of spaces counts one piece a space and
scores below what the vocabulary allows without that split.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from siftworks.llm.common import hold, ship_package, slices, text_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0


def unigram_vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces of a SentencePiece model with unigram log-probabilities.

    The public model is a BPE one, ordered by merge rank and without
    probabilities; the rule is a Zipf-Mandelbrot law of the rank,
    ``p ~ 1 / (id + 2.7)``, normalised over the vocabulary.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = model.get_piece_size()
    total = math.fsum(1 / (i + 2.7) for i in range(n))
    return [(model.id_to_piece(i), -math.log((i + 2.7) * total)) for i in range(n)]


class PieceCounter:
    """Best score and piece count of texts; caches up to ``limit`` words."""

    def __init__(self, vocabulary: list[tuple[str, float]], limit: int = 700_000):
        import ahocorasick

        self.limit = limit
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.singles = {p for p, _ in vocabulary if len(p) == 1}
        self.cache: dict[str, tuple[float, int]] = {}

    def word(self, word: str) -> tuple[float, int]:
        """(score, pieces) of one marked word, by the dynamic programme."""
        n = len(word)
        singles, unknown = self.singles, self.unknown
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        done = 0  # ends up to here are final

        def close(upto: int) -> None:
            # the unknown character is an end's last candidate: its start is
            # the latest one
            nonlocal done
            for end in range(done + 1, upto + 1):
                c = word[end - 1]
                if c not in singles:
                    s = best[end - 1] + unknown
                    if not count[end] or s > best[end]:
                        best[end], count[end] = s, count[end - 1] + len(c.encode())
            done = upto

        for last, (size, score) in self.automaton.iter(word):
            end = last + 1
            if end - 1 > done:
                close(end - 1)
            start = end - size
            s = best[start] + score
            if not count[end] or s > best[end]:
                best[end], count[end] = s, count[start] + 1
        close(n)
        return best[n], count[n]

    def text(self, text: str | None) -> tuple[int, float]:
        """(pieces, best score) of a whole text; null and empty have none."""
        if not text:
            return 0, 0.0
        if len(self.cache) > self.limit:
            self.cache.clear()
        cache, pieces, score = self.cache, 0, 0.0
        text = text.replace(MARK, " ")
        for w in (text[1:] if text[0] == " " else text).split(" "):
            got = cache.get(w)
            if got is None:
                got = self.word(MARK + w)
                if len(w) <= 64:
                    cache[w] = got
            score += got[0]
            pieces += got[1]
        return pieces, score


def count_pieces(df: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces and best_score of every whole text; one row in, one out.

    Null and empty texts have no pieces and score 0.  No shuffle.
    """
    ship_package(df.sparkSession)

    def run(batches):
        import pyarrow as pa

        counter = hold(("counter", model_path), lambda: PieceCounter(unigram_vocabulary(model_path)))
        for whole in batches:
            for batch in slices(whole, 4 << 20, "text"):
                got = [counter.text(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.float64())],
                    names=["doc_id", "n_pieces", "best_score"],
                )

    rows = df.select(df[f"`{id_col}`"].alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_pieces long, best_score double")
