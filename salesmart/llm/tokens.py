"""Token ids of whole texts, exactly as the tokenizers library gives them.

Both public vocabularies split a text into pre-tokens at white space before any merge, and no
pre-token holds a visible character followed by white space. Cutting a text in front of a
single space therefore cuts between pre-tokens, and the ids of the text are the ids of its
chunks in order. Chunks repeat heavily in prose, so each worker keeps a bounded table from
chunk to ids and asks the library only for chunks it has not met. A word followed by one sign is
two pre-tokens, so the word alone is asked for. New chunks are joined again into longer texts, one
call for many, and the ids are cut apart where the chunks end.

Where the cut would not be safe (a space between other white space stands inside one pre-token;
the string of a special token is one id wherever it stands) the whole text goes to the library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np

from salesmart.llm.buffers import pieces

#: Chunks that a worker remembers (about 150 bytes each), and what it hands to the library at once.
CACHE_ENTRIES = 1_000_000
BATCH_CHARS = 1_000_000
BATCH_TEXTS = 4_000
#: Chunks joined into one text, and the length from which a chunk goes alone.
JOINED, LONG = 200, 200
#: Joined texts in one call: the library's results take some 200 bytes a token while they are held.
CALL_GROUPS = 20
SIGNS = frozenset(",.;:!?)")
_INNER_SPACE = re.compile(r"\s (?:\s|\Z)").search
_ENCODERS: dict[tuple[str, bool], "Encoder"] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _is_word(s: str) -> bool:
    """Latin letters only, also in lower case. (Elsewhere normal forms and lower cases may end in marks,
    which a sign joins, and the library may know another version of Unicode.)"""
    return s.isalpha() and max(s) < "\u0250" and s.lower().isalpha()


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u2").tobytes()


class Encoder:
    """``ids(texts)`` yields the ids of each text as little-endian unsigned 16-bit bytes.

    ``drops_space`` says that the vocabulary drops white space (word vocabulary) instead of
    making it part of the next token (byte vocabulary).
    """

    def __init__(self, path: str, drops_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are stored in 16 bits; the vocabulary is larger")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.drops_space = drops_space
        self.known: dict[str, bytes] = {}
        self.sign = dict(zip(SIGNS, self._encode(list(SIGNS))))
        if drops_space:
            # a visible character that is one id: where it stands alone, that id can mean nothing else
            self.mark, self.mark_id = next((c, ids[0]) for c in "\u2605\u2665\u2022*|~" if len(
                ids := self.tokenizer.encode(c, add_special_tokens=False).ids) == 1)
        else:
            self.size = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
            for token, i in self.tokenizer.get_vocab().items():
                self.size[i] = len(token)                # a character of a byte-level token is a byte

    def _chunks(self, text: str) -> list[str] | None:
        """Keys of the chunks: what follows a space, without it; a space marks the chunk that follows none."""
        if any(t in text for t in self.special):
            return None
        if self.drops_space:
            return [c for c in text.replace("\n", " ").split(" ") if c]
        if "  " in text or _INNER_SPACE(text):
            return None
        chunks = text.split(" ")
        chunks[0] = " " + chunks[0]
        return chunks

    def _text(self, key: str) -> str:
        return key if self.drops_space else key[1:] if key[:1] == " " else " " + key

    def _encode(self, texts: list[str]) -> Iterable[bytes]:
        for group in _groups(texts):
            for e in self.tokenizer.encode_batch_fast(group, add_special_tokens=False):
                yield _packed(e.ids)

    def _encode_joined(self, keys: list[str]) -> Iterable[bytes]:
        """Ids of many short chunks, each of which follows a space, from few calls."""
        groups = [keys[i:i + JOINED] for i in range(0, len(keys), JOINED)]
        joint = f" {self.mark} " if self.drops_space else " "
        found = (e for i in range(0, len(groups), CALL_GROUPS) for e in self.tokenizer.encode_batch_fast(
            [" " + joint.join(g) for g in groups[i:i + CALL_GROUPS]], add_special_tokens=False))
        for group, e in zip(groups, found):
            ids = np.array(e.ids, dtype="<u2")
            if self.drops_space:
                end = np.flatnonzero(ids == self.mark_id)
                first, end = np.r_[0, end + 1], np.r_[end, len(ids)]
            else:
                bytes_ = np.cumsum([len(k.encode("utf-8", "surrogatepass")) + 1 for k in group])
                end = np.searchsorted(np.cumsum(self.size[ids]), bytes_) + 1
                first = np.r_[0, end[:-1]]
            data = ids.tobytes()
            for a, b in zip((2 * first).tolist(), (2 * end).tolist(), strict=True):
                yield data[a:b]

    def _alone(self, key: str) -> bool:
        return len(key) >= LONG or (self.mark in key if self.drops_space else not key or key[0] == " ")

    def _learn(self, new: set[str]) -> None:
        known = self.known
        signed = [c for c in new if c[-1:] in SIGNS and _is_word(c[:-1])]
        ask = new.difference(signed)
        ask.update(s for c in signed if (s := c[:-1]) not in known)
        alone = list(filter(self._alone, ask))
        joined = list(ask.difference(alone))
        known.update(zip(alone, self._encode(list(map(self._text, alone)))))
        known.update(zip(joined, self._encode_joined(joined), strict=True))
        known.update([(c, known[c[:-1]] + self.sign[c[-1]]) for c in signed])

    def ids(self, texts: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
        chunks = [self._chunks(t) for t in texts]
        self._learn(set().union(*(cs for cs in chunks if cs is not None)).difference(known))
        whole = iter(self._encode([t for t, cs in zip(texts, chunks) if cs is None]))
        return [next(whole) if cs is None else b"".join(map(known.__getitem__, cs))
                for cs in chunks]


def _groups(texts: list[str], chars: int = BATCH_CHARS) -> Iterable[list[str]]:
    """Lists of texts of about ``chars`` characters; one longer text stands alone."""
    group, size = [], 0
    for t in texts:
        if group and (size + len(t) > chars or len(group) >= BATCH_TEXTS):
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def encoder(path: str, drops_space: bool) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = (path, drops_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, drops_space)
    return _ENCODERS[key]


def encode_batches(batches, path: str, drops_space: bool):
    """(doc ids, id bytes) for groups of texts of bounded size, over Arrow batches with the
    columns doc_id and text."""
    enc = encoder(path, drops_space)
    for batch in batches:
        for first, part in pieces(batch.column("text"), BATCH_CHARS):
            yield batch.column("doc_id").slice(first, len(part)).to_pylist(), enc.ids(part.to_pylist())
