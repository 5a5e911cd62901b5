"""Exact token ids with a public tokenizer, each distinct piece of text encoded once per worker.

A byte-pair tokenizer cuts a text into pieces by a fixed pattern and encodes each piece on
its own, so the ids of a text are those of its pieces, one after another. Corpora repeat
pieces: a worker keeps what it has encoded, up to ``KEPT`` pieces, and looks up the rest.
Whether a vocabulary file cuts texts so is tried when it is opened; with one that does not, texts are
encoded whole. Texts with characters beyond Latin-1, where the pattern's classes are not spelled out here,
are given to the tokenizer whole, as are those that spell a special token where it has its id.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

KEPT = 700_000
JOINED = 500

# --- fixed values: the pieces of both tokenizers, for Latin-1 text -----------

LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBER = "0-9²³¹¼½¾"
BLANK = "\t-\r \x85\xa0"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

# --- end of fixed values -----------------------------------------------------

BYTE_LEVEL = re.compile(
    f"{CONTRACTIONS}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+"
    f"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)
WORD_END = re.compile(f"{CONTRACTIONS}|[{LETTER}]+|[{NUMBER}]|[^{BLANK}{LETTER}{NUMBER}]+")
BEYOND = re.compile("[^\x00-\xff]")
#: Text on which a vocabulary file must agree with the pieces above, or its texts are encoded whole.
PROBE = (
    "It's what they'd say: I'LL, we've. Don't  stop\n\n\tnow 12 345 6½ x² (a)b--c ... 'quoted' mixedCase ALLCAPS "
    "naïve Straße ªº µm \x85\xa0 end \x1c\x00# $5.99 user@example.org https://a.b/c?d=e&f  \r\n   tail   "
)

#: Classes of Latin-1 characters; ``EDGE`` stands between texts.
LETTERS, NUMBERS, OTHERS, BLANKS, EDGE = range(5)
CLASSES = np.array(
    [
        next((k for k, chars in enumerate((LETTER, NUMBER)) if re.match(f"[{chars}]", chr(c))),
             BLANKS if re.match(f"[{BLANK}]", chr(c)) else OTHERS)
        for c in range(256)
    ],
    dtype=np.uint8,
)


def byte_level_cuts(texts: list[str]) -> tuple[pa.BinaryArray, np.ndarray]:
    """What ``BYTE_LEVEL`` finds in Latin-1 texts, all at once: pieces in Latin-1, and where each text ends.

    After the pieces of each text stands one more, of no meaning; the places are those of these.
    """
    data = np.frombuffer(("\0".join(texts) + "\0\0\0").encode("latin-1"), dtype=np.uint8)[:-2]
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    kind = CLASSES[data]
    kind[ends] = EDGE
    start = np.empty(len(data), dtype=bool)
    start[0], start[1:] = True, kind[1:] != kind[:-1]
    start[ends] = True
    # The last blank ahead of a word: a space is the word's, another blank is a piece of its own.
    last = np.flatnonzero((kind[:-1] == BLANKS) & (kind[1:] < BLANKS))
    start[last] = True
    start[last[data[last] == ord(" ")] + 1] = False
    # Contractions, where a piece starts with an apostrophe.
    quote = np.flatnonzero(start & (data == ord("'")))
    quote = quote[quote + 1 < len(data)]
    one = data[quote + 1]
    two = data[np.minimum(quote + 2, len(data) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[quote[short | long] + 1] = False
    start[quote[short] + 2] = True
    start[quote[long] + 3] = True
    at = np.flatnonzero(start)
    offsets = np.append(at, len(data)).astype(np.int32)
    pieces = pa.BinaryArray.from_buffers(
        pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )
    return pieces, np.searchsorted(at, ends)


def chains(piece: str) -> bool:
    """Whether a Latin-1 piece is a space and letters: such are cut in the same places when written one after another."""
    return piece[0] == " " and piece[1:].isalpha()


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, to which no special tokens are added.

    Text that spells a special token is ordinary text, or with ``special_ids`` the token's
    one id, as by the library's default.
    """

    def __init__(self, path: str, special_ids: bool = False) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_ids
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if special_ids and added else None
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        size = max(self.tokenizer.get_vocab().values()) + 1
        #: What tells one id from another in files: two bytes if all ids fit.
        self.width = 2 if size <= 1 << 16 else 4
        self.word_end = any(name.endswith("</w>") for name in names)
        #: Ids that end a piece (word-end vocabulary), or start one (byte-level vocabulary).
        self.marks = np.zeros(size, dtype=bool)
        for name, number in names.items():
            self.marks[number] = name.endswith("</w>") if self.word_end else name[0] == "Ġ"
        self.known: dict[str, bytes] = {}
        self.cuts = True
        self.cuts = self.encode([PROBE, PROBE[::-1]]) == self.whole([PROBE, PROBE[::-1]])

    def pieces(self, text: str) -> list[str] | None:
        """The tokenizer's own pieces; None where the text has to be encoded whole."""
        if not self.cuts or BEYOND.search(text) or self.special and self.special.search(text):
            return None
        return WORD_END.findall(text.lower()) if self.word_end else BYTE_LEVEL.findall(text)

    def whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in encoded]

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces not met before; many at once where their ids can be told apart."""
        joinable = pieces if self.word_end else [p for p in pieces if chains(p)]
        glue = " " if self.word_end else ""
        for at in range(0, len(joinable), JOINED):
            part = joinable[at : at + JOINED]
            encoded = self.tokenizer.encode_batch_fast([glue.join(part)], add_special_tokens=False)
            ids = np.asarray(encoded[0].ids, dtype="<u4")
            places = np.flatnonzero(self.marks[ids])
            starts = np.concatenate([[0], places[:-1] + 1]) if self.word_end else places
            if len(starts) != len(part):
                self.known.update(zip(part, self.whole(part)))
                continue
            data, ends = ids.tobytes(), [*(4 * starts[1:]).tolist(), 4 * len(ids)]
            for piece, start, end in zip(part, (4 * starts).tolist(), ends):
                self.known[piece] = data[start:end]
        rest = [] if self.word_end else [p for p in pieces if not chains(p)]
        if rest:
            self.known.update(zip(rest, self.whole(rest)))

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces; those not met before are learnt."""
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > KEPT:
            self.known = {p: self.known[p] for p in pieces if p in self.known}
        self.learn(new)
        return [self.known[p] for p in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, in order."""
        if self.word_end:
            return self.encode_one_by_one(texts)
        plain = [
            self.cuts and not BEYOND.search(t) and not (self.special and self.special.search(t))
            for t in texts
        ]
        beyond = iter(self.whole([t for t, p in zip(texts, plain) if not p]))
        found = iter(self.encode_at_once([t for t, p in zip(texts, plain) if p]))
        return [next(found) if p else next(beyond) for p in plain]

    def encode_at_once(self, texts: list[str]) -> list[bytes]:
        """The ids of Latin-1 texts with a byte-level vocabulary: each distinct piece of them is looked up once."""
        if not texts:
            return []
        pieces, ends = byte_level_cuts(texts)
        coded = pieces.dictionary_encode()
        ids = self.ids_of([p.decode("latin-1") for p in coded.dictionary.to_pylist()])
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        code = coded.indices.to_numpy()
        n_ids = sizes[code]
        n_ids[ends] = 0
        until = np.cumsum(n_ids)
        places = np.repeat(starts[code] - (until - n_ids), n_ids) + np.arange(until[-1])
        data, edges = flat[places].tobytes(), [0, *(4 * until[ends]).tolist()]
        return [data[a:b] for a, b in zip(edges, edges[1:])]

    def encode_one_by_one(self, texts: list[str]) -> list[bytes]:
        cut = [self.pieces(t) for t in texts]
        met = set(chain.from_iterable(c for c in cut if c))
        new = [p for p in met if p not in self.known]
        if len(self.known) + len(new) > KEPT:
            self.known = {p: self.known[p] for p in met if p in self.known}
        self.learn(new)
        found = self.known.__getitem__
        beyond = iter(self.whole([t for t, c in zip(texts, cut) if c is None]))
        return [next(beyond) if c is None else b"".join(map(found, c)) for c in cut]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_ids: bool = False) -> Encoder:
    """The worker's encoder of a vocabulary file; what it has learnt lasts over tasks."""
    if (path, special_ids) not in _ENCODERS:
        _ENCODERS[path, special_ids] = Encoder(path, special_ids)
    return _ENCODERS[path, special_ids]


def public_vocabulary(name: str) -> str:
    """Path of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
