"""Word BPE ids of texts: the tokenizer's own model runs once per distinct word of a task.

Input normalisation of the tokenizer file (NFC, white space, lower case) acts within white-space words, and its
pattern never spans white space, so a text's ids are its words' ids in order.  Words of plain Latin characters are
lower-cased and split here and only the merge model runs; other words go through the whole tokenizer.
"""

import numpy as np
import regex
from tokenizers import Tokenizer, pre_tokenizers

#: Separators that Python's split() takes as white space and the tokenizer does not.
ODD_SPACE = regex.compile("[\x1c-\x1f]")
#: Words for which lower() and the split below equal the tokenizer's own (no combining marks, no special casing).
PLAIN = regex.compile("[\x21-įı-ɏ]+")
#: Words that an encoder keeps, twice at most: a younger generation, and the one before it, whose used words move on.
#: Each Python worker holds one encoder; 300,000 words a generation took about 360 MB a worker once full.
MAX_CACHED_WORDS = 50_000
#: Words that one call of the merge model gets.
CHUNK = 2_000


def byte_chars():
    """Byte value -> character that byte-level vocabularies use for it."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder:
    """``payloads(texts)``: ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer_json, cached=MAX_CACHED_WORDS):
        self.full = Tokenizer.from_str(tokenizer_json)
        self.full.encode_special_tokens = True
        self.merges = Tokenizer(self.full.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.is_end = np.zeros(self.full.get_vocab_size(), bool)
        self.is_end[[i for token, i in self.full.get_vocab(False).items() if token.endswith("</w>")]] = True
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.chars = byte_chars()
        self.words, self.old = {}, {}  # white-space word -> payload
        self.cached = cached

    def payloads(self, texts):
        split = [None if ODD_SPACE.search(text) else text.split() for text in texts]
        if len(self.words) > self.cached:
            self.words, self.old = {}, self.words
        unknown = set().union(*filter(None, split)).difference(self.words)
        again = unknown.intersection(self.old)
        self.words.update([(word, self.old[word]) for word in again])
        self._learn(unknown - again)
        known = self.words.__getitem__
        return [
            self._whole(text) if words is None else b"".join(map(known, words)) for text, words in zip(texts, split)
        ]

    def _whole(self, text):
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words):
        whole, pieces = [], []
        for word in words:
            if not word.isascii() and not PLAIN.fullmatch(word):
                self.words[word] = self._whole(word)
            elif word.isalpha():
                whole.append(word)
            else:
                pieces.append((word, self.pattern.findall(word.lower())))
        lower = [word.lower() for word in whole]
        known = self._merged(list(set(lower).union(*[p for _, p in pieces]))).__getitem__
        self.words.update(zip(whole, map(known, lower)))
        self.words.update([(word, b"".join(map(known, p))) for word, p in pieces])

    def _merged(self, tokens):
        """Pre-tokens with their payloads; the merge model runs over many at once, each one's ids end with a word-end token."""
        parts = [tokens[at : at + CHUNK] for at in range(0, len(tokens), CHUNK)]
        shown = [" ".join([t if t.isascii() and t.isprintable() else self._shown(t) for t in part]) for part in parts]
        merged = {}
        for part, encoded in zip(parts, self.merges.encode_batch_fast(shown, add_special_tokens=False)):
            ids = np.array(encoded.ids, "<u4")
            stops = ((np.flatnonzero(self.is_end[ids]) + 1) * 4).tolist()
            payload = ids.tobytes()
            merged.update(zip(part, [payload[a:b] for a, b in zip([0, *stops], stops)]))
        return merged

    def _shown(self, token):
        return "".join([self.chars[b] for b in token.encode()])


def batches(column, most_chars=1_000_000):
    """Slices of an Arrow text column holding about ``most_chars`` each (one text at least)."""
    texts, chars = [], 0
    for text in column:
        texts.append(text.as_py())
        chars += len(texts[-1])
        if chars >= most_chars:
            yield texts
            texts, chars = [], 0
    if texts:
        yield texts
