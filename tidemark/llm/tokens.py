"""Token ids of public tokenizers, encoded in Arrow batches on the executors."""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Ids of this many distinct parts of words are kept by each Python worker.
CACHED_WORDS = 800_000
# White space that str.split() knows and tokenizers do not, and the other way round.
_UNUSUAL = "\x1c\x1d\x1e\x1f\x85\u180e\u200b"
# Marks that are always apart from a letter before them: no apostrophe, no bracket of a special token.
_MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"


def vocabulary_path(name: str) -> str:
    """Place of an installed public vocabulary file; evaluated where it is called."""
    import public_tokenizers

    return public_tokenizers.path(name)


def gathered(pool: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The stretches of a pool, whose sizes are given, in the order of ``codes``."""
    own = sizes[codes]
    skipped = (np.cumsum(sizes) - sizes)[codes] - (np.cumsum(own) - own)
    return pool[np.arange(int(own.sum())) + np.repeat(skipped, own)]


class WordEncoder:
    """Ids of whole texts for a tokenizer that drops white space and never merges across it.

    Words are looked up in a bounded cache, as the bytes of their ids (of this machine's byte order); only words not
    seen before go through the tokenizer.
    """

    def __init__(self, name: str, special_as_text: bool = False, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(name))
        self.tokenizer.encode_special_tokens = special_as_text
        self.letter = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.cache: dict[str, bytes] = {}
        self.cached = cached

    def _looked_up(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts; a bounded number of them is kept for the next batch."""
        known = self.cache
        found = list(map(known.get, parts))
        fresh = [at for at, ids in enumerate(found) if ids is None]
        if fresh:
            room = max(0, self.cached - len(known))
            encodings = self.tokenizer.encode_batch_fast([parts[at] for at in fresh], add_special_tokens=False)
            for place, (at, encoding) in enumerate(zip(fresh, encodings)):
                found[at] = ids = array(self.letter, encoding.ids).tobytes()
                if place < room:
                    known[parts[at]] = ids
        return found

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and how many each has.

        Marks at the end are apart from a word of letters, and case is dropped, so ASCII words that differ
        only in those are a stem and its marks, which are encoded once.
        """
        low = pc.ascii_lower(words)
        base = pc.ascii_rtrim(low, _MARKS)
        plain = pc.and_(pc.string_is_ascii(words), pc.ascii_is_alpha(base))
        stems = pc.if_else(plain, base, words).dictionary_encode()
        marked = np.flatnonzero(pc.and_(plain, pc.less(pc.binary_length(base), pc.binary_length(low))).to_numpy(False))
        # What is cut off is as long as the word is longer.
        ends = pc.extract_regex(low.take(pa.array(marked)), "(?P<marks>[^a-z]+)$").field("marks").dictionary_encode()
        parts = self._looked_up(stems.dictionary.to_pylist()) + self._looked_up(ends.dictionary.to_pylist()) + [b""]
        second = np.full(len(words), len(parts) - 1)
        second[marked] = len(stems.dictionary) + ends.indices.to_numpy()
        both = np.stack([stems.indices.to_numpy(), second], 1).ravel()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // array(self.letter).itemsize
        ids = gathered(np.frombuffer(b"".join(parts), self.letter), sizes, both)
        return ids, sizes[both].reshape(-1, 2).sum(1)

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, as 32-bit numbers, and where each text's end; null is empty.

        Texts are split, their words numbered and cut a whole array at a time; Python sees distinct stems only, and
        ids are gathered by number.
        """
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        odd = pc.match_substring_regex(texts, f"[{_UNUSUAL}]")
        split = pc.utf8_split_whitespace(pc.if_else(odd, pa.scalar("", pa.large_string()), texts))
        coded = split.flatten().dictionary_encode()
        pool, sizes = self._word_ids(coded.dictionary)
        codes = coded.indices.to_numpy()
        ids = gathered(pool, sizes, codes).astype(np.uint32)
        offsets = np.asarray(split.offsets)
        ends = np.concatenate(([0], np.cumsum(sizes[codes])))[offsets[1:] - offsets[0]]
        if not pc.any(odd).as_py():
            return ids, ends
        whole = np.split(ids, ends[:-1])
        for at in np.flatnonzero(odd.to_numpy(False)):
            whole[at] = np.array(self.tokenizer.encode(texts[int(at)].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
        return np.concatenate(whole), np.cumsum([len(part) for part in whole])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as 32-bit numbers."""
        if not texts:
            return []
        ids, ends = self.encode_array(pa.array(texts, pa.large_string()))
        return np.split(ids, ends[:-1])


_encoders: dict[tuple[str, bool, int], WordEncoder] = {}


def word_encoder(name: str, special_as_text: bool = False, cached: int = CACHED_WORDS) -> WordEncoder:
    """The worker's own encoder, kept from task to task."""
    key = (name, special_as_text, cached)
    if key not in _encoders:
        _encoders[key] = WordEncoder(name, special_as_text, cached)
    return _encoders[key]
