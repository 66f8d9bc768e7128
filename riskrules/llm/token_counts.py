"""Token counts of a unigram tokenizer without making tokens: count-only Viterbi.

A text is a blank-free string (blanks become the piece mark, one is put in front). An Aho-Corasick
automaton of the vocabulary lists the pieces that end at each place; dynamic programming carries the
best score of a segmentation up to the place and its number of pieces. Of equal scores the piece that
begins first wins, as in the tokenizer's own Viterbi search, which takes over a path only if it is
strictly better. A letter that is no piece is one unknown of the worst score less ten; with byte pieces
it counts as one token per UTF-8 byte, otherwise a run of unknowns is one token.

Vocabulary and scores are those of a public model file; the file's integer scores add up exactly, so
texts may be cut wherever no piece reaches across, and each distinct part is searched once while it is
remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from riskrules.llm.common import Remembered, keyed_texts, per_text

MARK = "▁"


class Vocabulary:
    """Pieces and scores of a model, and whether unknown letters fall back to bytes."""

    def __init__(self, pieces: dict[str, float], bytes_known: bool, least: float):
        self.pieces, self.bytes_known, self.unknown = pieces, bytes_known, least - 10.0

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        normal = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in normal}
        return cls(pieces, any(model.is_byte(i) for i in ids), min(pieces.values()))


class Counter:
    """Best score and token count of whole texts."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.inside = {p[i : i + 2] for p in vocabulary.pieces for i in range(len(p) - 1)}
        exact = all(float(s).is_integer() and abs(s) < 1 << 40 for s in vocabulary.pieces.values())
        # Cuts need exact sums for ties and byte counts for unknowns; otherwise a text is one part.
        self.cuts = exact and vocabulary.bytes_known
        before_mark = self.cuts and not any(pair[1] == MARK and pair[0] != MARK for pair in self.inside)
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if before_mark else None
        self.parts, self.found = Remembered(self.search), Remembered(self._word)

    def search(self, part: str) -> tuple[float, int]:
        """The dynamic program over one part."""
        n = len(part)
        score, count, loose = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, piece in self.automaton.iter(part):
            ending[end].append(piece)  # the longest first
        for end in range(n):
            best, begin = None, end
            for size, s in ending[end]:
                total = score[end + 1 - size] + s
                if best is None or total > best:
                    best, begin = total, end + 1 - size
            if not ending[end] or ending[end][-1][0] > 1:
                total = score[end] + self.v.unknown
                if best is None or total > best:
                    more = len(part[end].encode("utf-8", "replace")) if self.v.bytes_known else int(not loose[end])
                    score[end + 1], count[end + 1], loose[end + 1] = total, count[end] + more, True
                    continue
            score[end + 1], count[end + 1] = best, count[begin] + 1
        return score[n], count[n]

    def _word(self, word: str) -> tuple[float, int]:
        """A word cut where no piece reaches across."""
        cuts = [0, *[i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.inside], len(word)]
        found = [self.parts[word[a:b]] for a, b in zip(cuts, cuts[1:])] if len(cuts) > 2 else [self.search(word)]
        return sum([f[0] for f in found]), sum([f[1] for f in found])

    def count(self, text: str) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        text = MARK + text.replace(" ", MARK)
        if not self.cuts:
            return self.search(text)
        found = list(map(self.found.__getitem__, self.words.findall(text) if self.words else [text]))
        return sum([f[0] for f in found]), sum([f[1] for f in found])


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per file and worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(Vocabulary.of(path))
    return _COUNTERS[path]


def counted(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, score) of every row: tokens and score of the best segmentation of the whole text.

    A null or empty text has no tokens and score 0. Repeated rows are counted each; ids may be null;
    bytes that are not UTF-8 count as the replacement mark.
    """

    def work(batches) -> Iterator[dict]:
        count = counter(path).count
        for ids, texts in batches:
            found = [count(t.decode(errors="replace")) for t in texts]
            yield {"doc_id": ids, "n_tokens": np.array([c for _, c in found], np.int64), "score": np.array([s for s, _ in found])}

    return per_text(keyed_texts(docs, key, text), work, "doc_id long, n_tokens long, score double")
