"""Token ids of whole texts, by a byte-level BPE vocabulary file of the tokenizers library.

Byte-level BPE first splits a text into pieces and merges within each piece, so a piece
always gets the same ids. ``Encoder`` asks the library for the ids of pieces it has not
met and keeps them in a bounded table, one per Python worker. Words between single blanks
are looked up whole, without the comma or full stop after them. Texts with characters
outside the plain set below, or that hold an added token of the vocabulary by name, such as
<|endoftext|>, go through the library whole, so every text gets the library's own ids: those
of ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``.
"""

import os
import re
from collections import defaultdict
from itertools import count, islice

import numpy as np

# The splitting rule of byte-level BPE vocabularies, over plain characters.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_PIECES = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"
)
_PLAIN = re.compile(rf"[\t-\r -~{_LETTERS}¡-©«¬®-±´¶-¸»¿×÷–—‘’“”…€]*")
# White space other than single blanks and single line ends within a text.
_SPACED = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\v", "\f")

# A comma or full stop that another sign precedes, with which it would make one piece.
_JOINED = re.compile(rf"[^{_LETTERS}0-9][.,][ \n]")

MEMO = 5_000_000  # characters of words that a worker keeps
CHUNK_CHARS = 2_000_000  # text handled at once
GLUED = "\x01"  # marks a word that follows a line end, not a blank


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary file ``name`` is installed on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    for themselves, the others by the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: 256 + i for i, b in enumerate(hidden)}


class Encoder:
    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        self.added = [token.content for token in added]
        self.model, self.letters, self.memo = self.library.model, _byte_letters(), memo
        self.blank = chr(self.letters[ord(" ")])
        self._forget()

    def _forget(self):
        self.words, self.kept = defaultdict(count().__next__), 0  # numbers as they come
        self.ids = np.zeros(0, np.uint32)
        self.starts = self.lengths = np.zeros(0, np.int64)

    def _whole(self, text):
        return self.library.encode(text, add_special_tokens=False).ids

    def _piece(self, piece):
        return [t.id for t in self.model.tokenize(self._spelled(piece))]

    def _spelled(self, piece):
        if piece.isascii() and piece.isprintable():  # all but the blank stand for themselves
            return piece.replace(" ", self.blank)
        return piece.encode().decode("latin-1").translate(self.letters)

    def _word(self, word):
        """Ids of a word that is not of letters only, as it stands after a blank, or after a
        line end if so marked."""
        if word[:1] == GLUED:
            return self._split(word[1:])
        return self._split(word if word == "\n" else " " + word)

    def _split(self, text):
        """Ids of a plain text, piece by piece."""
        return [i for p in _PIECES.findall(text) for i in self._piece(p)]

    def _learn(self, words):
        """Ids of words just numbered, behind those of the words before them."""
        tokenize, blank, flat, ends = self.model.tokenize, self.blank, [], []
        for word in words:
            if word.isalpha():  # one piece, with the blank before it
                spelled = blank + word if word.isascii() else self._spelled(" " + word)
                flat += [t.id for t in tokenize(spelled)]
            else:
                flat += self._word(word)
            ends.append(len(flat))
        lengths = np.diff(ends, prepend=0)
        self.kept += sum(map(len, words))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.array(ends) - lengths])
        self.ids = np.concatenate([self.ids, np.array(flat, np.uint32)])
        self.lengths = np.concatenate([self.lengths, lengths])

    def _word_ids(self, words):
        """Ids of the words in a row, and how many each word has."""
        if self.kept > self.memo:
            self._forget()
        known = len(self.words)
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        if new := len(self.words) - known:
            try:
                self._learn(list(islice(reversed(self.words), new))[::-1])
            except BaseException:  # numbered, but without ids
                self._forget()
                raise
        lengths = self.lengths[at]
        shift = self.starts[at] - (np.cumsum(lengths) - lengths)
        return self.ids[np.repeat(shift, lengths) + np.arange(lengths.sum())], lengths

    def encode(self, texts) -> list[np.ndarray]:
        """The ids (uint32) of each text; a missing text counts as empty."""
        out = [None] * len(texts)
        held, words, counts, chars = [], [], [], 0

        def flush():
            ids, lengths = self._word_ids(words)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            for i, a, b in zip(held, ends[at[:-1]], ends[at[1:]], strict=True):
                out[i] = ids[a:b]

        for i, text in enumerate(texts):
            if not text:
                out[i] = np.zeros(0, np.uint32)
            elif any(name in text for name in self.added) or not _PLAIN.fullmatch(text):
                out[i] = np.array(self._whole(text), np.uint32)
            elif text[0].isspace() or text[-1].isspace() or any(s in text for s in _SPACED):
                out[i] = np.array(self._split(text), np.uint32)
            else:
                own = GLUED + text
                if not _JOINED.search(text):
                    for sign in ",.":
                        own = own.replace(f"{sign} ", f" {GLUED}{sign} ")
                        own = own.replace(f"{sign}\n", f" {GLUED}{sign}\n")
                own = own.replace("\n", f" \n {GLUED}").split(" ")
                held.append(i)
                words.extend(own)
                counts.append(len(own))
                chars += len(text)
                if chars >= CHUNK_CHARS:
                    flush()
                    held, words, counts, chars = [], [], [], 0
        if held:
            flush()
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for the vocabulary file at ``path``."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
