"""Ids of whole texts by the tokenizers library, with every distinct chunk of a batch encoded once.

A text is cut where the tokenizer's own pre-tokenizer cuts in any context (before a blank, around a lone line
break, before a comma or full stop that follows a Latin letter), so the ids of the chunks, put together, are the ids
of the text. Texts where a cut isn't certain take a slower rule, or are encoded as they are.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Appended to each document.
END_ID = 1

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_SPACE = "\t-\r \u0085   -     　"
#: Blanks beside the plain space and line break.
_OTHER_BLANKS = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\u0085\u00a0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_DOUBLE_BLANKS = ("  ", " \n", "\n ", "\n\n")
#: For bytes.translate: Latin letters become a, commas and full stops a full stop, all else a blank.
_KINDS = bytes(ord("a") if re.match("[A-Za-zÀ-ÖØ-öø-ÿ]", chr(i)) else ord(".") if chr(i) in ",." else 32 for i in range(256))
_BYTE_CHUNKS = re.compile(f" ?[{_LETTER}]+(?=[{_SPACE},.]|$)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_END = "\x02END"
_PLAIN = re.compile(f" ?[{_LETTER}]+")
#: The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_ALPHABET = {b: 256 + i for i, b in enumerate(sorted({*range(256)} - _PRINTABLE))}


def default_path(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _awkward(text: str) -> bool:
    return "\0" in text or "\x02" in text or "<|" in text


def _blanks(text: str) -> bool:
    """Whether the text holds two blanks in a row or one other than a space or line break."""
    return any(x in text for x in _DOUBLE_BLANKS) or any(x in text for x in _OTHER_BLANKS)


def _stop_apart(text: str) -> bool:
    """Whether a comma or full stop follows anything but a Latin letter."""
    kinds = text.encode("latin-1", "replace").translate(_KINDS)
    return kinds.startswith(b".") or b" ." in kinds or b".." in kinds


class ChunkEncoder:
    """Encodes batches of texts. `limit` bounds the remembered chunks, `piece_chars` the characters worked on at once."""

    def __init__(self, path: str, limit: int = 800_000, piece_chars: int = 3_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.byte_level = "ByteLevel(" in str(self.tokenizer.pre_tokenizer)[:10]
        self.limit, self.piece_chars, self.known, self.older = limit, piece_chars, {}, {}
        self.known[_END] = np.array([END_ID], np.uint32).tobytes()

    def _marked(self, text: str) -> str:
        """The text with chunks parted by NUL, and the end mark as its last chunk."""
        if _awkward(text):
            return _END  # encoded apart
        if not self.byte_level:
            out = text.replace(" ", "\0").replace("\n", "\0")
        elif _blanks(text):
            return "\0".join([*_BYTE_CHUNKS.findall(text), _END])
        else:
            out = text.replace(" ", "\0 ").replace("\n", "\0\n\0")
        if not _stop_apart(text):
            out = out.replace(",", "\0,").replace(".", "\0.")
        return f"{out}\0{_END}"

    def _spelt(self, words: list[str]) -> list[str]:
        """Runs of Latin letters as the model's alphabet spells them, a character for each UTF-8 byte."""
        text = "\0".join(words)
        text = text if self.byte_level else text.lower()
        if text.isascii():  # of these only the blank has another character in the alphabet
            return text.replace(" ", chr(_ALPHABET[32])).split("\0")
        return text.encode().decode("latin-1").translate(_ALPHABET).split(chr(_ALPHABET[0]))

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """Two generations are remembered, so that common chunks stay when rare ones fill the limit."""
        known, older = self.known, self.older
        out = list(map(known.get, chunks))
        new = [c for c, ids in zip(chunks, out) if ids is None]
        if older:
            known.update([(c, older[c]) for c in new if c in older])
            new = [c for c in new if c not in known]
        plain, accented, rest = [], [], []
        for c in new:
            if _PLAIN.fullmatch(c) and (self.byte_level or c[0] != " "):
                (plain if c.isascii() else accented).append(c)
            else:
                rest.append(c)
        tokenize = self.model.tokenize
        for words in (plain, accented):
            for c, word in zip(words, self._spelt(words)):
                known[c] = array("I", [t.id for t in tokenize(word)]).tobytes()
        for i in range(0, len(rest), 1024):
            part = rest[i : i + 1024]
            for c, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known[c] = array("I", e.ids).tobytes()
        if None in out:
            out = [known[c] if ids is None else ids for c, ids in zip(chunks, out)]
        if len(known) > self.limit // 2:
            self.known, self.older = {_END: known[_END]}, known
        return out

    def _piece(self, texts: list[str]) -> list[np.ndarray]:
        lists = pc.split_pattern(pa.array([self._marked(t) for t in texts], pa.large_string()), "\0")
        coded = lists.values.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        ids = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        first = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int32)
        flat = np.frombuffer(b"".join(ids), np.uint32)
        n = size[codes]
        end = np.cumsum(n)
        total = int(end[-1]) if len(end) else 0
        at = np.repeat((first[codes] - (end - n)).astype(np.int32), n)
        at += np.arange(total, dtype=np.int32)
        out = flat[at]
        stops = np.concatenate([[0], end])[lists.offsets.to_numpy()]
        docs = [out[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())]
        for i, t in enumerate(texts):
            if _awkward(t):
                docs[i] = np.array([*self.tokenizer.encode(t, add_special_tokens=False).ids, END_ID], np.uint32)
        return docs

    def encode(self, texts: list[str | None]):
        """Yields a uint32 array for each text, its end id included; a null text counts as an empty one."""
        piece, chars = [], 0
        for t in texts:
            t = t or ""
            if piece and chars + len(t) > self.piece_chars:
                yield from self._piece(piece)
                piece, chars = [], 0
            piece.append(t)
            chars += len(t)
        if piece:
            yield from self._piece(piece)


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each file and worker process."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
