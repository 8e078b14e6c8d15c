"""BPE encoding and decoding by reuse of content-defined chunks.

A rolling hash over a text's bytes cuts it where the bytes themselves say so: the same passage gives the same chunks in
every document. Each chunk is encoded once for as long as it stays in a bounded store; where two chunks meet, the text
around the joint is encoded again, further to both sides, until its pieces agree with those of the chunks.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections import OrderedDict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.shared import id_or_none, known_id

TOKENIZER = "byte_bpe_50k.json"
#: The pre-tokenizer's pattern for ByteLevel with use_regex, as its library documents it.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points on which the two libraries' character classes are known to agree: ASCII, Latin letters, dashes, quotes.
UNUSUAL = r"[^\t-\r\x20-\x7e\u00a1-\u024f\u2010-\u2027]"
#: A chunk ends where the hash of the last WINDOW bytes has SURE_BITS zero bits before a space, or ANY_BITS anywhere.
WINDOW, SURE_BITS, ANY_BITS = 16, 6, 13
STORE_BYTES = 24_000_000
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public tokenizer's file lies on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Coder:
    """Encodes and decodes exactly as the tokenizers library does with one file and add_special_tokens=False."""

    def __init__(self, path: str, store_bytes: int = STORE_BYTES):
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        letters = byte_letters()
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        known = {i: b for b, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.bytes_of = [known.get(i, b"") for i in range(max(known) + 1)]
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        self.fast = tiktoken.Encoding("chunks", pat_str=PIECE, mergeable_ranks=vocab, special_tokens={})
        self.piece = regex.compile(PIECE)
        self.unusual = re.compile(UNUSUAL)
        self.cut_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.store: OrderedDict[str, tuple[int, ...]] = OrderedDict()
        self.store_bytes, self.held = store_bytes, 0
        rng = np.random.default_rng(20240607)
        self.table = rng.integers(0, 2**32, 256, dtype=np.uint32)

    def cuts(self, data: bytes) -> np.ndarray:
        """Byte positions where a chunk ends, always between code points."""
        raw = np.frombuffer(data, np.uint8)
        n = len(raw)
        if n <= WINDOW:
            return np.empty(0, np.int64)
        # A cyclic polynomial of a window is that of its left half, rotated by the half's width, xor that of its right half.
        hashed, width = self.table[raw], 1
        while width < WINDOW:
            left = hashed[:-width]
            hashed = ((left << np.uint32(width)) | (left >> np.uint32(32 - width))) ^ hashed[width:]
            width *= 2
        hashed = hashed[: n - WINDOW]
        at = np.flatnonzero(hashed >> np.uint32(32 - SURE_BITS) == 0)
        anywhere = hashed[at] >> np.uint32(32 - ANY_BITS) == 0
        at += WINDOW
        before_space = (raw[at] == 0x20) & (raw[at - 1] > 0x20)
        return at[before_space | (anywhere & ((raw[at] & 0xC0) != 0x80))]

    def encode_text(self, text: str) -> list[int]:
        """Ids by whichever library is exact on the text and quicker."""
        if text.isascii() or not self.unusual.search(text):
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk, encoded once while the store holds it; the oldest used go first."""
        found = self.store.get(chunk)
        if found is not None:
            self.store.move_to_end(chunk)
            return found
        ids = self.encode_text(chunk)
        self.store[chunk] = ids
        self.held += 160 + len(chunk) + 40 * len(ids)
        while self.held > self.store_bytes:
            old, gone = self.store.popitem(last=False)
            self.held -= 160 + len(old) + 40 * len(gone)
        return ids

    def joined(self, left: str, right: str) -> bool:
        """Whether a piece surely ends at the joint, however the texts go on: no space before it and a space after it."""
        return right[:1] == " " and not left[-1:].isspace()

    def encode_plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens, chunk by chunk.

        Where a joint isn't sure, pieces of the text from the left chunk's last sure start are cut again; the first
        piece end past the joint that is also one of the right chunk's is where both agree, for pieces depend on nothing
        before them. Ids up to the left start and from there on are those of the chunks; between them they are encoded
        again. A piece that swallows a whole chunk goes on into the next one.
        """
        data = text.encode("utf-8")
        ends = self.cuts(data)
        if not len(ends):
            return self.encode_text(text)
        if len(data) == len(text):
            bounds = [0, *ends.tolist(), len(text)]
        else:  # positions in code points
            starts = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            bounds = [0, *(starts[ends - 1]).tolist(), len(text)]
        ids: list[int] = []
        at = 0  # all before it is encoded
        for i in range(1, len(bounds)):
            start, end = bounds[i - 1], bounds[i]
            if at > start:  # a joint's repair has gone into this chunk
                if at >= end:
                    continue
                start = at
            chunk = text[start:end]
            if end == len(text) or self.joined(chunk, text[end : end + 1]):
                ids += self.encode_chunk(chunk)
                at = end
                continue
            # The last piece, and spaces before it, may be cut otherwise once the text goes on.
            pieces = [m.start() for m in self.piece.finditer(chunk)]
            sure = pieces[-1]
            while sure > 0 and chunk[sure - 1].isspace():
                pieces.pop()
                sure = pieces[-1]
            ids += self.encode_chunk(chunk[:sure]) if sure else []
            at = self.agreed(text, start + sure, end, bounds, i)
            ids += self.encode_text(text[start + sure : at]) if at > start + sure else []
        return ids

    def agreed(self, text: str, start: int, joint: int, bounds: list[int], i: int) -> int:
        """The first position past the joint where pieces cut from `start` and pieces cut from the joint both end."""
        reach = i + 1
        while True:
            stop = bounds[min(reach, len(bounds) - 1)]
            last = stop == len(text)
            own = {joint + m.end() for m in self.piece.finditer(text[joint:stop])}
            for m in self.piece.finditer(text[start:stop]):
                end = start + m.end()
                # A piece that ends at the cut, or spaces before it, might go on past it.
                if end > joint and end in own and (end < stop or last) and (end == len(text) or not text[end - 1].isspace()):
                    return end
            if last:
                return stop
            reach *= 2

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; the strings of special tokens are those tokens, as the file has them."""
        if self.cut_special is None or not self.cut_special.search(text):
            return self.encode_plain(text)
        ids, at = [], 0
        for m in self.cut_special.finditer(text):
            ids += self.encode_plain(text[at : m.start()]) if m.start() > at else []
            ids.append(self.special[m.group()])
            at = m.end()
        return ids + (self.encode_plain(text[at:]) if at < len(text) else [])

    def decode_bytes(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text, special tokens included; broken sequences become U+FFFD, as the library has it."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return raw.decode("utf-8", "replace").encode("utf-8")


def digests(batches: Iterator[pd.DataFrame], path: str | None) -> Iterator[pd.DataFrame]:
    """doc_id, number of ids, digests of ids and of the decoded text, for each batch of (doc_id, text)."""
    coder = Coder(path or tokenizer_path())
    for docs in batches:
        rows = []
        for doc_id, text in zip(docs["doc_id"], docs["text"], strict=True):
            ids = coder.encode(text if isinstance(text, str) else "")
            listed = ",".join(map(coder.decimal.__getitem__, ids)).encode()
            rows.append((doc_id, len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(coder.decode_bytes(ids)).hexdigest()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encoded(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) of each batch of (doc_id, text)."""
    coder = Coder(path or tokenizer_path())
    for docs in batches:
        ids = pa.array([coder.encode(t or "") for t in docs.column(1).to_pylist()], pa.list_(pa.int32()))
        yield pa.record_batch([docs.column(0), ids], names=["doc_id", "ids"])


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of whole texts; null is empty and has no ids; rows stay where they are (no shuffle)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda b: encoded(b, path), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each whole text encoded, and its ids decoded.

    Null and empty texts have no ids; repeated rows give equal rows; other columns are left out. One pass without a
    shuffle: a lost task encodes its own rows again. `path` is the tokenizer's file on the executors.
    """
    rows = docs.select(id_or_none(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(lambda b: digests(b, path), RESULT).withColumn("doc_id", known_id("doc_id"))
