"""Token ids of whole texts from a public tokenizer file, with every distinct word encoded once per worker."""

from __future__ import annotations

import hashlib
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Marks that may follow a word.
MARKS = b".,;:!?|*#$%&"
IS_MARK = np.isin(np.arange(256), list(MARKS))
#: Letters that are small and composed: what turns A-Z to a-z and composes marks leaves them as they are.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
#: Their last bytes, of those with one byte and of those with two, which all begin with ``LEAD``.
ONE_BYTE, TWO_BYTES = (np.isin(np.arange(256), [x.encode()[-1] for x in LETTERS if len(x.encode()) == size]) for size in (1, 2))
LEAD = 0xC3
#: Words kept with their ids in one worker, as the bytes of words and ids and ``ENTRY`` more for each: half of it for words of late, half for those before.
KEPT_BYTES, ENTRY = 128 << 20, 250


class WordIds:
    """Ids as the tokenizer gives them, for tokenizers that drop white space and never join what it separates."""

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.lower = self.tokenizer.encode("A'Bc., ").ids == self.tokenizer.encode("a'bc., ").ids
        self.model = self.tokenizer.model
        self.letters, self.bytewise = self.passing()
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.held = 0

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """For each text in UTF-8 its ids as unsigned 32-bit numbers; each distinct word of ``texts`` is looked up once."""
        split = pc.ascii_split_whitespace(self.apart(texts))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        self.meet(words)
        found = pa.array(list(map(self.known.__getitem__, words)), pa.large_binary()).take(coded.indices)
        _, ends, flat = found.buffers()
        first = np.frombuffer(ends, np.int64)[split.offsets.to_numpy()] // 4
        flat = np.frombuffer(flat or b"", "<u4", first[-1])
        return [flat[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]

    def apart(self, texts: list[bytes]) -> pa.Array:
        """The texts with A-Z as a-z and a space between a letter and a mark behind it, unless a text might spell a special token."""
        if not (self.lower and self.letters):
            return pa.array(texts, pa.large_binary()).cast(pa.large_string())
        special = np.array([b"<|" in text for text in texts], bool)
        data = np.frombuffer(b"".join([text if as_is else text.lower() for text, as_is in zip(texts, special, strict=True)]), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(text) for text in texts], dtype=np.int64)])
        at = np.flatnonzero(IS_MARK[data])
        at = at[at >= 2]
        last = data[at - 1]
        at = at[ONE_BYTE[last] | TWO_BYTES[last] & (data[at - 2] == LEAD)]
        at = at[~special[np.searchsorted(offsets, at, "right") - 1]]
        offsets += np.searchsorted(at, offsets)
        return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(np.insert(data, at, ord(" "))))

    def meet(self, words: list[bytes]) -> None:
        """Afterwards all ``words`` are known."""
        if self.held > KEPT_BYTES // 2:  # words that come again are taken over, the others are forgotten at the next turn
            self.before, self.known, self.held = self.known, {}, 0
        known, before = self.known, self.before
        known[b""] = b""
        new = [word for word in words if word not in known]
        known.update((word, before[word]) for word in new if word in before)
        self.learn([word for word in new if word not in known])
        self.held += sum(len(word) + len(known[word]) for word in new) + ENTRY * len(new)

    def passing(self) -> tuple[re.Pattern | None, dict[int, str]]:
        """Pattern of words that are one piece for the model, and their letters as the model has them; no pattern if a probe says otherwise.

        For such words what the tokenizer does before the model is left out; it takes most of the time.
        """
        normalizer, cutter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        if normalizer is None or cutter is None or not all("<|" in content for content in special):
            return None, {}

        def pieces(text: str) -> list[str]:
            return [piece for piece, _ in cutter.pre_tokenize_str(normalizer.normalize_str(text))]

        seen = {letter: pieces(letter) for letter in LETTERS}
        bytewise = {ord(letter): own[0] for letter, own in seen.items() if len(own) == 1}
        one = all(pieces(text) == [text.translate(bytewise)] for text in (LETTERS, LETTERS[::-1]))
        same = all(bytewise.get(ord(letter)) == letter for letter in LETTERS if letter.isascii())
        cut = all(pieces(letter + mark) == [*own, *pieces(mark)] for letter, own in seen.items() for mark in MARKS.decode())
        return (re.compile(f"[{LETTERS}]+"), bytewise) if one and same and cut else (None, {})

    def learn(self, new: list[bytes]) -> None:
        """Adds words; only those that are not plain letters go through the whole tokenizer."""
        known, other = self.known, []
        for word in new:
            text = word.decode()
            if self.letters and self.letters.fullmatch(text):
                own = self.model.tokenize(text if text.isascii() else text.translate(self.bytewise))
                known[word] = array("I", [token.id for token in own]).tobytes()
            else:
                other.append(text)
        encoded = self.tokenizer.encode_batch_fast(other, add_special_tokens=False)
        known.update((text.encode(), array("I", found.ids).tobytes()) for text, found in zip(other, encoded, strict=True))


_LOADED: dict[str, WordIds] = {}


def word_ids(definition: str) -> WordIds:
    """One instance for each tokenizer and worker, so that words seen by earlier tasks are known."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = WordIds(definition)
    return _LOADED[key]
