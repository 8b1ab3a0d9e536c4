"""Token ids of whole texts by a ``tokenizers`` file, with each distinct chunk encoded once.

Both kinds of vocabulary used here pre-split a text at white space, so a text may be cut at a
single space (or line end) between two other characters without changing any id.  The chunks
repeat: Arrow splits the texts and finds the distinct chunks, and the library's ids of each are
kept in a bounded cache of the Python worker.  A text in which such a cut could matter is
encoded whole by the library.
"""

from __future__ import annotations

import itertools
import os
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np

#: set between chunks that are encoded in one call; its ids mark the chunk ends
_BETWEEN = "\n\x00\n"
#: "\x01" before a chunk of ``space_leads`` says that no space precedes it
_NO_SPACE = "\x01"
#: letters whose normal form and pre-splitting no tokenizer version changes, and what may end such a word
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyzÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_WORD = re.compile(f"[{_LETTERS}]+").fullmatch
#: signs that may end such a word; none is part of an added token
_SIGNS = ",.!?;:#$%&*()-"
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: the printable stand-ins of byte-level vocabularies: a byte itself if it is printed, else the next free character
_STAND_IN = str.maketrans({chr(b): chr(b if b in _PRINTED else 256 + sum(x not in _PRINTED for x in range(b))) for b in range(256)})


def _in_bytes(text: str) -> str:
    return text.encode().decode("latin-1").translate(_STAND_IN)


class ChunkEncoder:
    """``encode(texts)`` gives all ids (end id after each text) and the count per text.

    ``space_leads``: the vocabulary's ids depend on the space before a word (else all white space
    is dropped).  At most ``max_chunks`` chunks and ``max_chars`` characters are kept; beyond that
    only the chunks met in several calls stay, at most half of them (results never depend on it).
    """

    def __init__(self, path: str, space_leads: bool, end_id: int, max_chunks: int = 150_000, max_chars: int = 1 << 23):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.space_leads, self.end_id = space_leads, end_id
        self.between = np.array(self._whole("x" + _BETWEEN + "x")[1:-1], np.uint32)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join(["\x00", *map(re.escape, self.added)])).search
        # words of plain letters need only the model, if the file's other steps do what is expected
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        letters = normal.normalize_str(_LETTERS) if normal else _LETTERS
        self.lower = letters == _LETTERS.lower()
        lead = " " * space_leads
        self.plain = (self.lower or letters == _LETTERS) and (
            [x for x, _ in split.pre_tokenize_str(f"{lead}{letters}{_SIGNS} .")] == [_in_bytes(x) for x in (lead + letters, _SIGNS, lead + ".")])
        self.plain = self.plain and not any(set(t) & set(_SIGNS) for t in self.added) and len(self._whole("x")) == 1
        self.model = self.tokenizer.model
        self.ends: dict[str, list[int]] = {}
        self.max_chunks, self.max_chars = max_chunks, max_chars
        self._reset()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _reset(self) -> None:
        self.index = defaultdict(itertools.count().__next__)
        self.index[None]  # chunk 0 stands for the end id
        self.flat = np.array([self.end_id], np.uint32)
        self.start, self.count = np.array([0], np.int32), np.array([1], np.int32)
        self.uses = np.zeros(1, np.int32)
        self.chars = 0

    def _shrink(self) -> None:
        """Leaves the chunks that several calls met, the more the fewer fit."""
        least = 2
        while (stays := self.uses >= least).sum() > self.max_chunks // 2 and least < 1 << 20:
            least *= 2
        kept = np.flatnonzero(stays)
        chunks = list(self.index)
        chunks = [chunks[i] for i in kept.tolist()]
        start, count, flat, uses = self.start[kept], self.count[kept], self.flat, self.uses[kept]
        self._reset()
        if (chars := sum(map(len, chunks))) > self.max_chars // 2:
            return
        for c in chunks:
            self.index[c]
        stop = np.cumsum(count, dtype=np.int32)
        place = np.repeat(start - (stop - count), count) + np.arange(int(stop[-1]) if len(stop) else 0, dtype=np.int32)
        self.start = np.concatenate([self.start, 1 + stop - count])
        self.count = np.concatenate([self.count, count])
        self.flat = np.concatenate([self.flat, flat[place]])
        # a chunk must be met again to stay the next time
        self.uses = np.concatenate([self.uses, uses // 2])
        self.chars = chars

    def _learn(self) -> None:
        """Encodes the chunks that the index has and the arrays have not."""
        new = list(itertools.islice(self.index, len(self.start), None))
        if not new:
            return
        if self.space_leads:
            chunks = [c[1:] if c.startswith(_NO_SPACE) else c if c == "\n" else " " + c for c in new]
        else:
            chunks = new
        flat: list[int] = []
        count = np.zeros(len(chunks), np.int32)
        rest, odd, index, n_known = [], {}, self.index, len(self.start)
        tokenize, ends, plain, lower, leads, before = self.model.tokenize, self.ends, self.plain, self.lower, self.space_leads, 0
        for i, c in enumerate(chunks):
            # a word and the signs at its end, which the file splits apart
            stem = c.rstrip(_SIGNS)
            word = stem[1:] if leads and stem[:1] == " " else stem
            end, is_ascii = c[len(stem):], word.isascii()
            if plain and (is_ascii and word.isalpha() or not is_ascii and _WORD(word)):
                # the word without those signs may be a chunk that is known
                if end and (k := index.get(new[i][:-len(end)], n_known)) < n_known:
                    flat += self.flat[self.start[k]:self.start[k] + self.count[k]].tolist()
                else:
                    if lower:
                        stem = stem.lower()
                    if leads or not is_ascii:
                        stem = _in_bytes(stem)
                    flat += [t.id for t in tokenize(stem)]
                if end:
                    if end not in ends:
                        if len(ends) > 4096:
                            ends.clear()
                        ends[end] = self._whole("x" + end)[1:]
                    flat += ends[end]
            else:
                rest.append(i)
            count[i] = len(flat) - before
            before = len(flat)
        # white space at a chunk's end, the mark itself or an added token would spoil a shared call
        alone = lambda i: not chunks[i] or chunks[i][-1].isspace() or self.odd(chunks[i]) is not None
        for is_alone, group in itertools.groupby(rest, alone):
            for part in itertools.batched(group, 1 if is_alone else 256):
                ids = self._whole(_BETWEEN.join(chunks[i] for i in part))
                if is_alone:
                    odd[part[0]] = ids
                    continue
                array, k = np.array(ids, np.uint32), len(self.between)
                stops = [*(np.flatnonzero(array == self.between[k // 2]) - k // 2).tolist(), len(ids)]
                assert len(stops) == len(part)
                for i, stop, start in zip(part, stops, [0, *(x + k for x in stops)]):
                    odd[i] = ids[start:stop]
        # the ids of plain words stand first, those of the other chunks behind them
        start = len(self.flat) + np.cumsum(count, dtype=np.int32) - count
        for i, ids in odd.items():
            start[i], count[i] = len(self.flat) + len(flat), len(ids)
            flat += ids
        self.start = np.concatenate([self.start, start])
        self.count = np.concatenate([self.count, count])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int32)])
        self.flat = np.concatenate([self.flat, np.array(flat, np.uint32)])
        self.chars += sum(map(len, new))

    def _chunks(self, texts):
        """Chunks of each text (an Arrow list array), and which texts must be encoded whole."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not self.space_leads:
            return pc.ascii_split_whitespace(texts), np.zeros(len(texts), bool)
        odd = pc.match_substring_regex(texts, r"[\x00\x01\x1c-\x1f\x85\xa0]|[^\x00-\x7f\x{a1}-\x{167f}\x{2070}-\x{2fff}\x{3001}-\x{10ffff}]"
                                              r"|^[\s\v]|[\s\v]$|[\t\r\f\v]|[ \n][ \n]")
        for content in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, content))
        odd = pc.or_(odd, pc.equal(texts, ""))
        lined = pc.replace_substring(texts, "\n", f" \n {_NO_SPACE}")
        lined = pc.binary_join_element_wise(pa.scalar(_NO_SPACE), lined, "")
        return pc.split_pattern(lined, " "), odd.to_numpy(zero_copy_only=False)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """``texts``: an Arrow string array or a list; NULL counts as empty."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.start) > self.max_chunks or self.chars > self.max_chars:
            self._shrink()
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lists, odd = self._chunks(texts)
        coded = lists.flatten().dictionary_encode()
        known = np.fromiter(map(self.index.__getitem__, coded.dictionary.to_pylist()), np.int32, len(coded.dictionary))
        self._learn()
        self.uses[known] += 1
        at = known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, np.int32)
        stops = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        at = np.insert(at, stops, 0)  # the end id after each text
        n = self.count[at]
        stop = np.cumsum(n, dtype=np.int64)
        place = np.repeat((self.start[at] - (stop - n)).astype(np.int32), n)
        place += np.arange(stop[-1], dtype=np.int32)
        ids = self.flat[place]
        per_text = np.diff(stop[stops + np.arange(len(stops))], prepend=0)
        if odd.any():
            parts = np.split(ids, np.cumsum(per_text)[:-1])
            for i in np.flatnonzero(odd):
                parts[i] = np.array([*self._whole(texts[int(i)].as_py()), self.end_id], np.uint32)
            ids, per_text = np.concatenate(parts), np.array(list(map(len, parts)), np.int64)
        return ids, per_text


@lru_cache(maxsize=2)
def chunk_encoder(path: str, space_leads: bool, end_id: int, max_chunks: int = 150_000) -> ChunkEncoder:
    """One encoder per Python worker."""
    return ChunkEncoder(path, space_leads, end_id, max_chunks)
