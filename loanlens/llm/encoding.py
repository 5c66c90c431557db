"""Texts to token ids, word by word, with what a worker process has learned kept from task to task.

Both encoders rest on the same fact: their tokenizers never join what a blank separates, so the ids
of a text are those of its words one after the other. Words of letters, perhaps with punctuation
behind them, are a single unit (and the punctuation another) for the tokenizer, so they go straight
to its merge table; all others go through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loanlens.llm.common import kept_by_worker

#: Words whose ids a worker remembers; those not met lately make room.
REMEMBERED = 400_000
#: Words of up to so many characters are remembered.
LONGEST_REMEMBERED = 64
#: Signs that are split off behind a word. The apostrophe is not: what follows it may be a token with it.
TAIL = ",.!#$%&*|?;:\"()"
#: Letters below this one are letters to every version of Unicode, and have no other composed form.
LATIN = "ɐ"
#: What a word without remembered ids has instead.
UNKNOWN = object()
#: Words that are cut into tokens by one call. Longer strings take longer a word.
WORDS_AT_ONCE = 32


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the others for the code points from 256 on.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


_SPELLED = str.maketrans(dict(enumerate(byte_letters())))


def spelled(word: str) -> str:
    """A word in the letters of a byte-level vocabulary."""
    return word.encode().decode("latin-1").translate(_SPELLED)


#: For patterns: letters below LATIN and signs of TAIL; in letters of a vocabulary, the bytes that letters beyond ASCII
#: begin with, the bytes behind those, whole letters (some more of them do no harm), a blank and a line end.
_LETTERS, _SIGNS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", re.escape(TAIL)
_LEADING, _LATER = (f"[{''.join(byte_letters()[a:b])}]" for a, b in ((0xC2, 0xCA), (0x80, 0xC0)))
_OTHER_LETTER = f"(?:{'|'.join(map(spelled, 'ªµº'))}|(?!{byte_letters()[0xC2]}){_LEADING}{_LATER})"
_BLANK, _LINE_END = spelled(" "), spelled("\n")


def is_latin(word: str) -> bool:
    """Whether the word consists of letters that all tables agree on."""
    return word.isalpha() and (word.isascii() or max(word) < LATIN)


class Learned(dict):
    """Ids by word; unknown words are learned when asked for, and beyond ``most`` words old ones make room."""

    def __init__(self, learn: Callable, most: int = REMEMBERED):
        self.learn, self.most, self.before = learn, most, {}

    def __missing__(self, word):
        found = self.before.get(word)
        if found is None:
            found = self.learn(word)
        if len(word) <= LONGEST_REMEMBERED:
            if 2 * len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[word] = found
        return found

    def all_of(self, words: list, learn: Callable) -> list:
        """The ids of different words; ``learn`` gets those that are not remembered, all at once."""
        found = [self.get(word, UNKNOWN) for word in words]
        old = [at for at, ids in enumerate(found) if ids is UNKNOWN]
        for at in old:
            found[at] = self.before.get(words[at], UNKNOWN)
        new = [at for at in old if found[at] is UNKNOWN]
        for at, ids in zip(new, learn([words[at] for at in new]), strict=True):
            found[at] = ids
        if 2 * (len(self) + len(old)) > self.most:
            self.before = dict(self)
            self.clear()
        self.update((words[at], found[at]) for at in old if len(words[at]) <= LONGEST_REMEMBERED)
        return found


class _Encoder:
    REMEMBERED = REMEMBERED

    def __init__(self, path: str, end: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        kept = kept_by_worker(f"{type(self).__name__} {path}")
        if "tokenizer" not in kept:
            from tokenizers import Tokenizer

            kept["tokenizer"] = Tokenizer.from_file(path)
            kept["merge"] = kept["tokenizer"].model.tokenize
        self.tokenizer, self.merge = kept["tokenizer"], kept["merge"]
        self.end = end.to_bytes(4, "little")
        self.known = kept.setdefault("known", Learned(None, self.REMEMBERED))
        self.known.learn = self._learn

    def _learn(self, word):
        raise NotImplementedError

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _merged(self, unit: str) -> bytes:
        return array("I", [token.id for token in self.merge(unit)]).tobytes()


class WordEncoder(_Encoder):
    """For the lower-casing vocabulary with word ends: texts to ids, the end id last."""

    def __init__(self, path: str, end: int = 1):
        super().__init__(path, end)

    def _learn(self, word: bytes) -> bytes:
        text = word.decode()
        if "<|" in text:  # special tokens are found before the text is lowered
            return self._whole(text)
        low = text.lower()
        if is_latin(low):
            return self._merged(spelled(low))
        body = low.rstrip(TAIL)
        if len(body) < len(low) and is_latin(body):
            return self.known[body.encode()] + self.known[low[len(body) :].encode()]
        return self._whole(text)

    def ids(self, text: bytes | None) -> bytes:
        """The ids of a text in UTF-8, little-endian."""
        return b"".join(map(self.known.__getitem__, (text or b"").split())) + self.end  # at ASCII blanks

    def __call__(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        for text in texts:
            yield np.frombuffer(self.ids((text or "").encode()), "<u4")


class ByteEncoder(_Encoder):
    """For the byte-level vocabulary: texts to ids, little-endian, the end id last.

    A word takes the blank before it along. So texts are cut before each single blank with other
    than white space on both sides; a word stands for itself and the blank before it, and for the
    bare word if a blank is put before it as a mark.
    """

    BARE = " "
    #: Letters below LATIN, signs of TAIL and single line ends between them: cut where one kind follows another, and only there.
    SIMPLE = re.compile(rf"[{_LETTERS}{_SIGNS}]+(?:\n[{_LETTERS}{_SIGNS}]+)*")
    #: What can be met within simple words with blanks between them, letters perhaps not whole, in letters of the vocabulary.
    WITHIN = re.compile(rf"{_LATER}?(?:[A-Za-z{_SIGNS}{_LINE_END}{_BLANK}]|{_OTHER_LETTER})*{_LEADING}?")
    #: Another kind behind a letter, a sign, a line end or the blank before a word.
    ACROSS = re.compile(rf"[{_SIGNS}][^{_SIGNS}]|[^{_SIGNS}{_BLANK}][{_SIGNS}]|[^{_LINE_END}]{_LINE_END}|{_LINE_END}[^{_LINE_END}]|[^{_BLANK}]{_BLANK}")
    #: Words stand here with what is behind them, a comma or a line end, so there are more of them. A worker that
    #: encodes does nothing else that needs memory, unlike in the pipeline.
    REMEMBERED = 600_000  # with 900,000 workers came near an executor's memory

    def _learn(self, word: str) -> bytes | None:
        if word.startswith(self.BARE):
            blank, inner = "", word[1:]
        else:
            blank, inner = " ", word
        if not inner or inner[0].isspace() or inner[-1].isspace():
            return None
        if is_latin(inner):
            return self._merged(spelled(blank + inner))
        body = inner.rstrip(TAIL)
        if len(body) < len(inner) and is_latin(body):
            bare = word[: len(word) - len(inner)] + body
            return self.known[bare] + self.known[self.BARE + inner[len(body) :]]
        if inner.strip(TAIL) == "":
            return self._merged(spelled(blank + inner))
        first, line_end, rest = inner.partition("\n")
        if line_end and first and rest and not first[-1].isspace() and not rest[0].isspace():
            return self.known[word[: len(word) - len(inner)] + first] + self._merged(spelled("\n")) + self.known[self.BARE + rest]
        return self._whole(blank + inner)

    def _pieces(self, text: str) -> bytes:
        """Texts with white space beside a blank: such runs stay together with the words around them."""
        out, words = [], text.split(" ")
        held, plain = self.BARE + words[0], True
        for word in words[1:]:
            if held[-1].isspace() or not word or word[0].isspace():
                held, plain = f"{held} {word}", False
            else:
                out.append(self._piece(held, plain))
                held, plain = word, True
        out.append(self._piece(held, plain))
        return b"".join(out)

    def _piece(self, held: str, plain: bool) -> bytes:
        found = self.known[held] if plain else None
        if found is None:
            return self._whole(held[1:] if held.startswith(self.BARE) else f" {held}")
        return found

    def __init__(self, path: str, end: int = 0):
        super().__init__(path, end)
        kept = kept_by_worker(f"{type(self).__name__} {path}")
        if "first" not in kept:
            kept["first"] = self._first_tokens()
        self.first = kept["first"]

    def _first_tokens(self) -> np.ndarray | None:
        """Whether an id begins with a blank. None if a token could reach across the parts of simple words."""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        first = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for token, number in vocabulary.items():
            first[number] = token.startswith(_BLANK)
            if self.ACROSS.search(token) and self.WITHIN.fullmatch(token):
                return None
        return first

    def _learn_all(self, words: list[str]) -> list[bytes | None]:
        """The ids of words, the simple ones cut into tokens many at a time."""
        if self.first is None:
            return [self._learn(word) for word in words]
        is_simple = [self.SIMPLE.fullmatch(word) is not None for word in words]
        simple, ids = list(compress(words, is_simple)), array("I")
        for at in range(0, len(simple), WORDS_AT_ONCE):
            ids.extend([token.id for token in self.merge(spelled(" " + " ".join(simple[at : at + WORDS_AT_ONCE])))])
        data, starts = ids.tobytes(), np.flatnonzero(self.first[np.frombuffer(ids, "u4")]).tolist()
        cut = iter([data[4 * a : 4 * b] for _, a, b in zip(simple, starts, [*starts[1:], len(ids)], strict=True)] if simple else [])
        return [next(cut) if plain else self._learn(word) for word, plain in zip(words, is_simple, strict=True)]

    def ids_of_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after the other, and how many each text has. A word of several texts is looked up once."""
        texts, n = texts.fill_null(""), len(texts)
        if not n:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        split = pc.split_pattern(texts, " ")
        starts = split.offsets.to_numpy().astype(np.int64)
        starts, counts = starts[:-1] - starts[0], np.diff(starts)
        words, is_first = split.flatten(), np.zeros(counts.sum(), bool)
        is_first[starts] = True
        others = pc.if_else(pa.array(is_first), pa.scalar(None, words.type), words).dictionary_encode()
        values = self.known.all_of(others.dictionary.to_numpy(zero_copy_only=False).tolist(), self._learn_all)
        places = others.indices.fill_null(0).to_numpy().astype(np.int64)
        places[starts] = np.arange(len(values), len(values) + n)
        values += [self.known[self.BARE + word] for word in words.take(pa.array(starts)).to_pylist()]
        last = np.full(n, len(values))
        values.append(self.end)
        odd = np.array([ids is None for ids in values])
        if odd.any():  # texts with a word that no single blank bounds are encoded by themselves
            apart = np.logical_or.reduceat(odd[places], starts)
            places, counts = places[np.repeat(~apart, counts)], np.where(apart, 0, counts)
            last[apart] = np.arange(len(values), len(values) + np.count_nonzero(apart))
            values += [self.ids(texts[at].as_py()) for at in np.flatnonzero(apart).tolist()]
        ends = np.cumsum(counts)
        taken = pa.array(values, pa.large_binary()).take(pa.array(np.insert(places, ends, last)))
        bounds = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)[np.append(0, ends + np.arange(1, n + 1))] // 4
        return np.frombuffer(taken.buffers()[2], "<u4", bounds[-1]), np.diff(bounds)

    def ids(self, text: str | None) -> bytes:
        """The ids of a text, little-endian."""
        if not text:
            return self.end
        words = text.split(" ")
        words[0] = self.BARE + words[0]
        try:
            return b"".join(map(self.known.__getitem__, words)) + self.end
        except TypeError:  # a word that no single blank bounds
            return self._pieces(text) + self.end
