"""Token ids of whole texts by the tokenizers library, asked once for each distinct piece that a worker meets.

A byte-level tokenizer splits a text by a fixed pattern before it merges, so the ids of a text are those of its pieces
in turn. Pieces are found here for texts in Latin letters; other texts, and texts that hold a special token, go to the
library whole.
"""

from __future__ import annotations

import codecs
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa

#: Letters and numbers below U+0250, and white space, in the sense of \p{L}, \p{N} and \s. Fixed values.
_L, _N = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\\t-\\r \x85\xa0"
PIECES = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
BEYOND = re.compile("[^\x00-ɏ]")
#: Distinct pieces that a worker remembers; past this it starts anew.
REMEMBER = 500_000
#: Bytes of one id, in the arrays here and in files.
WIDE = 4
assert array("I").itemsize == WIDE and sys.byteorder == "little"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself, and the rest, in order, for U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b if b in own else next(rest)) for b in range(256))


class Encoder(dict):
    """Texts -> ids as little-endian unsigned 32-bit integers; as a dictionary, it has the ids of pieces, and asks the library's model for those it has not."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, piece: str) -> bytes:
        spelt = codecs.charmap_decode(piece.encode(), "strict", self.letters)[0]
        ids = self[piece] = array("I", [t.id for t in self.merges(spelt)]).tobytes()
        return ids

    def plain(self, text: str) -> bool:
        return not BEYOND.search(text) and not any(s in text for s in self.specials)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        get = self.__getitem__
        for text in texts:
            if len(self) > REMEMBER:
                self.clear()
            if self.plain(text):
                yield b"".join(map(get, PIECES.findall(text)))
            else:
                yield array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The worker's own encoder; a worker that Spark uses again keeps what it has learnt."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = path or tokenizer_path()
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that what a worker makes of one batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def mapped(f: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if (out := f(batch)) is not None and out.num_rows:
                yield out

    return run


def texts(column: pa.Array) -> list[str]:
    """Values with null as the empty text."""
    return [t or "" for t in column.to_pylist()]
