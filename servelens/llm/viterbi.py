"""Token counts under a unigram vocabulary: Viterbi over Aho-Corasick matches, counting only.

The vocabulary is a list of pieces with scores.  For each end position the dynamic programme
keeps the best score and the number of pieces on that path; no pieces are materialised.  Ties
follow the tokenizer: for an end position candidates are tried by ascending start, a later one
wins only with a strictly better score, and the unknown piece of one character (tried only where
no single-character piece matches) comes last.  With byte fallback an unknown character counts
one token per UTF-8 byte.  Control, unknown and byte pieces ('<s>', '<unk>', '<0x0A>') are names and
never match text that is written like them.

The named file may be a BPE file, as the one of the registered query is: its pieces and scores are then
read as a unigram vocabulary, and the counts are those of that reading, not of the file's own merges.

Texts are cut where no piece of the vocabulary can cross (before a run of the space mark, and on
both sides of a character that occurs in no piece), so each distinct chunk is scored once and its
count kept in a bounded cache of the Python worker.  Scores of the fixed vocabularies are whole
numbers, for which cutting changes no sum.  NULL and empty texts have no tokens.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servelens.llm.common import text_slices

MARK = "▁"


@lru_cache(maxsize=2)
def load_pieces(model_path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a sentencepiece file, in id order (id 0 is the unknown piece)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()))


@lru_cache(maxsize=2)
def load_names(model_path: str) -> frozenset[str]:
    """Pieces of a sentencepiece file that stand for no text: control, unknown, unused and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return frozenset(model.id_to_piece(i) for i in range(model.get_piece_size())
                     if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))


class Counter:
    """Counts the pieces of a text; ``unknown_penalty`` lies below the lowest score, as the tokenizer has it.
    ``names``: pieces that match no text."""

    def __init__(self, pieces: tuple[tuple[str, float], ...], byte_fallback: bool = True, unknown_penalty: float = 10.0,
                 max_chunks: int = 400_000, max_chars: int = 1 << 24, names: frozenset[str] = frozenset()):
        import ahocorasick

        self.unknown = min(s for _, s in pieces) - unknown_penalty
        self.byte_fallback = byte_fallback and all(any(p == f"<0x{b:02X}>" for p, _ in pieces) for b in range(256))
        pieces = tuple((p, s) for p, s in pieces if p not in names)
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        known = {c for p, _ in pieces for c in p}
        # no cut before a mark if some piece holds one after another character; neighbouring
        # unknown characters make one piece without byte fallback and must then stay together
        apart = all(MARK not in p.lstrip(MARK) for p, _ in pieces) and (self.byte_fallback or MARK in self.single)
        lines = self.byte_fallback and "\n" not in known
        cut = rf"(?s){MARK}+[^\n{MARK}]*|\n|[^\n{MARK}]+" if lines else rf"(?s){MARK}+[^{MARK}]*|[^{MARK}]+"
        self.chunks = re.compile(cut if apart else "(?s).+").findall
        self.kept: dict[str, int] = {}
        self.max_chunks, self.max_chars, self.chars = max_chunks, max_chars, 0

    def score_chunk(self, chunk: str) -> int:
        n = len(chunk)
        best = [float("-inf")] * (n + 1)
        count = [0] * (n + 1)
        best[0] = 0.0
        matches = self.automaton.iter(chunk)
        end, (length, score) = next(matches, (n, (0, 0.0)))
        fused = [False] * (n + 1) if not self.byte_fallback else None
        for e in range(1, n + 1):
            top, pieces, unknown = float("-inf"), 0, False
            while end == e - 1:  # longest piece first: ascending start
                s = best[e - length] + score
                if s > top:
                    top, pieces = s, count[e - length] + 1
                end, (length, score) = next(matches, (n, (0, 0.0)))
            c = chunk[e - 1]
            if c not in self.single and best[e - 1] + self.unknown > top:
                top = best[e - 1] + self.unknown
                if self.byte_fallback:
                    pieces = count[e - 1] + len(c.encode())
                else:  # neighbouring unknown characters make one unknown piece
                    pieces, unknown = count[e - 1] + (not fused[e - 1]), True
            best[e], count[e] = top, pieces
            if fused is not None:
                fused[e] = unknown
        return count[n]

    def count(self, text: str) -> int:
        """Number of tokens of a text whose spaces are marked."""
        kept, total = self.kept, 0
        for chunk in self.chunks(text):
            n = kept.get(chunk)
            if n is None:
                if len(kept) >= self.max_chunks or self.chars > self.max_chars:
                    kept.clear()
                    self.chars = 0
                n = kept[chunk] = self.score_chunk(chunk)
                self.chars += len(chunk)
            total += n
        return total


@lru_cache(maxsize=2)
def counter(model_path: str) -> Counter:
    return Counter(load_pieces(model_path), names=load_names(model_path))


def marked(text: str) -> str:
    """The normal form of the vocabulary: a mark before the text and for each space."""
    return MARK + text.replace(" ", MARK) if text else ""


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_chars, n_tokens`` of every whole text."""
    def run(batches):
        import pyarrow as pa

        model = counter(model_path)
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64())])
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, texts in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b], pa.int64()), pa.array(list(map(len, texts)), pa.int64()),
                     pa.array([model.count(marked(t)) for t in texts], pa.int64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, n_tokens long")
