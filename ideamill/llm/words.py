"""Token ids of whole texts, one lookup per word.

The vocabulary's pre-tokenizer drops white space and never joins what it separates, so a text has
the ids of its ASCII-space-separated words one after the other. Each word is encoded once per
worker and then found in a bounded memo.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np

# Words in each of a memo's two generations, and bytes of text looked up together.
MEMO_WORDS = 150_000
GROUP_BYTES = 1 << 20
# ASCII marks that may end a word; the apostrophe is missing, as it starts contractions.
_ENDS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{|}~<>"
_LATIN_END = chr(0x250)


def byte_marks() -> list[str]:
    """The printable character that stands for each byte value in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    marks = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in marks:
            marks[b] = chr(256 + len(marks) - len(shown))
    return [marks[b] for b in range(256)]


def split_words(raw: bytes) -> list[bytes]:
    """The words between ASCII white space, in lower case where that can't change an id.

    Capitals stay where a special token's mark could arise from them, or where lower case would
    change how combining marks compose.
    """
    if b"<|" in raw:
        return raw.split()
    low = raw.lower()
    if not raw.isascii():
        normal = unicodedata.is_normalized
        if not (normal("NFC", raw.decode("utf-8", "replace")) and normal("NFC", low.decode("utf-8", "replace"))):
            return raw.split()
    return low.split()


def letters_of(word: bytes) -> str | None:
    """The word in lower case if it is one pre-token of Latin letters, else None."""
    text = word.decode("utf-8", "replace")
    if text.isalpha() and max(text) < _LATIN_END and unicodedata.is_normalized("NFC", text):
        text = text.lower()
        return text if text.isalpha() else None
    return None


class WordMemo:
    """word -> value for the words of texts, made once per worker for many words at a time.

    letters(list of str) gives the values of pre-tokens of lower-case Latin letters, whole(str) that
    of any other word, both(a, b) that of two words written together. Words not used while
    MEMO_WORDS others came are forgotten.
    """

    def __init__(self, letters: Callable, whole: Callable, both: Callable):
        self.letters, self.whole, self.both = letters, whole, both
        self.now: dict = {}
        self.older: dict = {}

    def values(self, raws: list[bytes]) -> Iterator[list]:
        """For each text the values of its words in order."""
        group, size = [], 0
        for i, raw in enumerate(raws):
            group.append(split_words(raw))
            size += len(raw)
            if size >= GROUP_BYTES or i == len(raws) - 1:
                self._learn(set().union(*group))
                find = self.now.__getitem__
                for words in group:
                    yield list(map(find, words))
                group, size = [], 0

    def _learn(self, words: set[bytes]) -> None:
        if len(self.now) > MEMO_WORDS:
            self.older, self.now = self.now, {}
        now, older = self.now, self.older
        new = words.difference(now)
        if older:
            known = new.intersection(older)
            now.update((w, older[w]) for w in known)
            new -= known
        plain, cut, ends = {w: w.lower().decode() for w in new if w.isalpha()}, [], set()
        for word in new.difference(plain):
            stem = word.rstrip(_ENDS)
            if stem and len(stem) < len(word):
                if stem not in plain:
                    if stem.isalpha():
                        if stem not in now:
                            plain[stem] = stem.lower().decode()
                    elif letters := letters_of(stem):
                        plain[stem] = letters
                    else:
                        self._whole(word)
                        continue
                end = word[len(stem):]
                ends.add(end)
                cut.append((word, stem, end))
            elif letters := letters_of(word):
                plain[word] = letters
            else:
                self._whole(word)
        for end in ends.difference(now):
            self._whole(end)
        now.update(zip(plain, self.letters(list(plain.values()))))
        now.update((w, self.both(now[s], now[e])) for w, s, e in cut)

    def _whole(self, word: bytes) -> None:
        self.now[word] = self.whole(word.decode("utf-8", "replace"))


def rank_encoding(tokenizer, end: str = "</w>", mark: bytes = b"\x01"):
    """The vocabulary by ranks for words that a mark follows, if its ids are in the order of its merges, else None.

    Joining the lowest rank first is what the merges do; the mark stands for the end of a word and may not be in it.
    """
    import tiktoken

    value = {m: bytes([b]) for b, m in enumerate(byte_marks())}
    model = json.loads(tokenizer.to_str())["model"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    places = [model["vocab"].get(a + b, -1) for a, b in merges]
    if places != sorted(places) or -1 in places or model["vocab"][mark_name := byte_marks()[mark[0]]] >= places[0]:
        return None
    ranks = {}
    for token, i in model["vocab"].items():
        stem, tail = (token.removesuffix(end), mark) if token.endswith(end) else (token, b"")
        if stem != mark_name and all(c in value for c in stem):
            ranks[b"".join(value[c] for c in stem) + tail] = i
    ranks[mark] = model["vocab"][mark_name]
    return tiktoken.Encoding("words", pat_str=r"[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={})


class LibraryIds:
    """Ids by the tokenizers library, packed as little-endian integers of the smallest fitting width."""

    _loaded: dict[str, LibraryIds] = {}

    @classmethod
    def of(cls, file: str) -> LibraryIds:
        """One per worker process, so that its memo serves all tasks of the worker."""
        if file not in cls._loaded:
            cls._loaded[file] = cls(file)
        return cls._loaded[file]

    def __init__(self, file: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.lean = Tokenizer.from_file(file), Tokenizer.from_file(file)
        for t in (self.tokenizer, self.lean):
            t.no_truncation()
            t.no_padding()
        # For words that no normalizer changes: the same model behind a split at spaces.
        self.ranks = rank_encoding(self.tokenizer)
        self.lean.normalizer = None
        self.lean.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.memo = WordMemo(self._letters, self._whole, lambda a, b: a + b)

    def _letters(self, words: list[str]) -> Iterator[bytes]:
        width = self.dtype.itemsize
        for i in range(0, len(words), 1_000):
            some = words[i:i + 1_000]
            if self.ranks:
                found = self.ranks.encode_ordinary("\x01".join([*some, ""]))
            else:
                found = self.lean.encode(" ".join(some), add_special_tokens=False).ids
            ids = np.array(found, self.dtype)
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * width).tolist()
            if len(stops) != len(some):
                raise ValueError("the vocabulary doesn't mark word ends")
            raw = ids.tobytes()
            yield from [raw[a:b] for a, b in zip([0, *stops], stops)]

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, raws: list[bytes]) -> Iterator[bytes]:
        """The packed ids of each whole text."""
        return map(b"".join, self.memo.values(raws))
