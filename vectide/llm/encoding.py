"""Token ids of texts by a tokenizers file, with the ids of recent chunks at hand.

Texts are cut at white space where the tokenizer's own rules never join what stands
on both sides, and the library encodes each distinct chunk once. The ids of a text
are those of its chunks in a row, gathered for all texts of a step at once.
"""

from __future__ import annotations

import re
import sys
from array import array
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vectide.llm.common import per_worker, tokenizer

#: Chunks of each of the two generations whose ids a worker remembers.
CACHE_ENTRIES = 300_000

#: Unicode white space, as the library's patterns understand it.
_S = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters of words that are one pre-token, and the marks between which and a letter both
#: tokenizers always cut. Marks that special tokens or contractions hold are not among them.
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = "!\"#$%&*+,-./:;=?@^_`~"
_LETTERS = frozenset(c for c in map(chr, range(256)) if re.match(f"[{_L}]", c))
#: A run of other characters with one space or line feed before it, or a run of white
#: space but for its last character where others follow.
_ATTACHED = re.compile(f"[ \\n]?[^{_S}]+|[{_S}]+(?=[{_S}][^{_S}])|[{_S}]+")
#: White space.
_SPACES = re.compile(f"[{_S}]")
#: Runs of other characters only.
_SEPARATE = re.compile(f"[^{_S}]+")
#: Words that are one pre-token as they stand.
_PLAIN = re.compile(f"[{_L}]+")
#: What keeps a text from being cut at single spaces and line feeds.
_ODD = ("  ", " \n", "\n ", "\n\n", *map(chr, (9, 11, 12, 13, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: White space other than spaces and line feeds.
_NOT_SINGLE = tuple(c for c in map(chr, range(0x3001)) if c not in " \n" and _SPACES.match(c))
#: Stands before a chunk without a space in front; no chunk of its own begins so.
_BARE = "\r"
#: Chunks that the library encodes in one call.
CALL = 10_000
#: Bytes of text that one step encodes: the more, the fewer chunks are looked up again.
STEP_BYTES = 4 << 20


def _little(values: array) -> array:
    if sys.byteorder == "big":
        values.byteswap()
    return values


_ID = attrgetter("id")


def _byte_alphabet() -> dict[str, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others follow from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable and b != 10]
    # A line feed separates the words here and is left alone; it is the eleventh of the others.
    rank = {b: k for k, b in enumerate(sorted([*others, 10]))}
    return {chr(b): chr(256 + rank[b]) for b in others}


class Encoder:
    """``encode`` gives the ids of texts as little-endian 32-bit bytes.

    Tokenizers whose first step splits by the byte-level pattern keep white space, as
    part of what follows it; those that drop it see each word on its own. Any other
    tokenizer gets whole texts, and so does any text that holds the string of a special
    token, for the rules on white space do not reach over that.
    """

    def __init__(self, path: str):
        self.library = tokenizer(path)
        # Chunks of this and the last generation; what is met again moves to this one.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.special: list[str] = []
        self.pattern = self._pattern()
        # Words of letters need no normalizer or splitting of their own, only lower case where
        # the tokenizer has it and the byte-level alphabet: its model then gives the same ids.
        self.model = self.library.model
        self.alphabet = str.maketrans(_byte_alphabet())

    def _pattern(self):
        import json

        spec = json.loads(self.library.to_str())
        splits = spec.get("pre_tokenizer") or {}
        self.special = [t["content"] for t in spec["added_tokens"]]
        if splits.get("type") == "ByteLevel" and splits["use_regex"] and not splits["add_prefix_space"] and not spec["normalizer"]:
            return _ATTACHED
        steps = splits.get("pretokenizers", [])
        words_only = (
            splits.get("type") == "Sequence"
            and steps[0]["type"] == "Split"
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
            and steps[0]["pattern"].get("Regex", "").endswith("[^\\s\\p{L}\\p{N}]+")
            and all(s["type"] == "ByteLevel" and not s["use_regex"] and not s["add_prefix_space"] for s in steps[1:])
        )
        harmless = {"NFC", "Lowercase", "Replace"}
        normal = spec.get("normalizer") or {"normalizers": []}
        named = [n["type"] for n in normal.get("normalizers", [normal])]
        return _SEPARATE if words_only and set(named) <= harmless else None

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), CALL):
            found = self.library.encode_batch_fast(texts[i : i + CALL], add_special_tokens=False)
            out += [_little(array("I", e.ids)).tobytes() for e in found]
        return out

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin letters, from the tokenizer's model."""
        if not words:
            return []
        joined = "\n".join(words)
        if self.pattern is _SEPARATE:
            joined = joined.lower()
        mapped = joined.encode().decode("latin-1").translate(self.alphabet).split("\n")
        tokenize = self.model.tokenize
        return [_little(array("I", map(_ID, tokenize(w)))).tobytes() for w in mapped]

    def _single(self, text: str) -> str | None:
        """The text with its chunks between single spaces, under their names; None where they do not stand so."""
        if self.pattern is _SEPARATE:
            # The empty chunk between two spaces has no ids.
            return None if any(c in text for c in _NOT_SINGLE) else text.replace("\n", " ")
        if not text or text[0].isspace() or text[-1].isspace() or any(c in text for c in _ODD):
            return None
        return _BARE + text.replace("\n", " \n " + _BARE)

    def _cut(self, text: str) -> list[str]:
        """The chunks of a text under the names that the memory has for them.

        With the byte-level pattern a chunk goes by what follows its space; chunks
        without one have ``_BARE`` or their line feed in front.
        """
        if self.pattern is _SEPARATE:
            return _SEPARATE.findall(text)
        found = _ATTACHED.findall(text)
        return [c[1:] if c[0] == " " and len(c) > 1 and not _SPACES.match(c, 1) else c if _SPACES.match(c) else _BARE + c for c in found]

    def _text(self, name: str) -> str:
        """What stands in the text for a chunk's name."""
        if self.pattern is _SEPARATE or name[0] == "\n":
            return name
        if name[0] == _BARE and len(name) > 1 and not _SPACES.match(name, 1):
            return name[1:]
        return name if _SPACES.match(name) else " " + name

    def _learn(self, chunks: list[str]) -> None:
        """Add chunks that are not known to this generation."""
        young, old = self.young, self.old
        new = []
        for c in chunks:
            ids = old.get(c)
            if ids is None:
                new.append(c)
            else:
                young[c] = ids
        # Words with a space in front, or none where there are no spaces; then those without.
        bare = self.pattern is not _SEPARATE
        plain = [c for c in new if _PLAIN.fullmatch(c)]
        young.update(zip(plain, self._word_ids([" " + c for c in plain] if bare else plain)))
        if bare:
            single = [c for c in new if c[0] == _BARE and _PLAIN.fullmatch(c, 1)]
            young.update(zip(single, self._word_ids([c[1:] for c in single])))
        rest = [c for c in new if c not in young]
        young.update(zip(rest, self._ids([self._text(c) for c in rest])))

    def _known(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks; marks behind a word are a chunk of their own."""
        bare = "" if self.pattern is _SEPARATE else _BARE
        heads = [c.rstrip(_MARKS) for c in chunks]
        tails: dict[int, str] = {}
        for k, (c, head) in enumerate(zip(chunks, heads)):
            if head is not c and len(head) < len(c):
                if head and head[-1] in _LETTERS:
                    tails[k] = bare + c[len(head) :]
                else:
                    heads[k] = c
        if len(self.young) > CACHE_ENTRIES:
            self.young, self.old = {}, self.young
        young = self.young
        young[""] = b""
        found = list(map(young.get, heads))
        unknown = [k for k, ids in enumerate(found) if ids is None]
        new = dict.fromkeys(heads[k] for k in unknown)
        new.update(dict.fromkeys(c for c in tails.values() if c not in young))
        self._learn(list(new))
        for k in unknown:
            found[k] = young[heads[k]]
        for k, tail in tails.items():
            found[k] += young[tail]
        return found

    def _rows(self, cut: pa.ListArray) -> list[bytes]:
        """Ids of texts from their chunks, which are looked up once each."""
        flat = cut.flatten().dictionary_encode()
        if not len(flat):
            return [b""] * len(cut)
        known = pa.array(self._known(flat.dictionary.to_pylist()), pa.large_binary())
        _, offsets, ids = known.take(flat.indices).buffers()
        # Texts are whole runs of chunks, so their ids are whole runs of these bytes.
        edges = np.frombuffer(offsets, np.int64)[cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
        raw = memoryview(ids if ids is not None else b"")
        return [raw[a:b].tobytes() for a, b in zip(edges, edges[1:])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        if self.pattern is None:
            return self._ids(texts)
        whole, odd, single, spaced = [], [], [], []
        for k, t in enumerate(texts):
            if any(s in t for s in self.special):
                whole.append(k)
            elif (found := self._single(t)) is None:
                odd.append(k)
            else:
                single.append(k)
                spaced.append(found)
        out = [b""] * len(texts)
        rows = self._rows(pc.split_pattern(pa.array(spaced, pa.string()), " "))
        rows += self._rows(pa.array([self._cut(texts[k]) for k in odd], pa.list_(pa.string())))
        rows += self._ids([texts[k] for k in whole])
        for k, ids in zip(single + odd + whole, rows):
            out[k] = ids
        return out


def encoder(path: str) -> Encoder:
    """The encoder of a file, one for each worker."""
    return per_worker(f"encoder:{path}", lambda: Encoder(path))
