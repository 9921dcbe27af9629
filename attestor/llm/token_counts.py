"""Token counts with a whole-token shortcut.

Offline, every vocabulary entry that ends a word is spelt out and encoded by the library; those that come back as one
token are proven to be whole tokens.  Texts are normalised (NFC, lower case character by character) and cut into
pre-tokens by runs of character classes; a pre-token of the proven list, found by hash and compared by its bytes, counts one without any merge.  Only
the rest is merged, each distinct pre-token once a worker, by the library's own merge table.  Special strings inside a
text count one each, and cut the text, before normalisation, as the library does by default.

Defined cases: a null text is empty and counts 0.  Rows may repeat; ids may be null or repeat; other columns are
ignored.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import NUMBER, SPACE, contracted, runs
from .common import SLICE_BYTES, Met, small_batches, spans_hash, text_rows

LIMIT = 2048
#: A worker forgets the pre-tokens that it has merged when there are more.
KNOWN = 500_000


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def whole_tokens(spec: str) -> list[bytes]:
    """The strings proven to encode alone as one token."""
    from tokenizers import Tokenizer

    of = {c: b for b, c in byte_letters().items()}
    words = []
    for entry in json.loads(spec)["model"]["vocab"]:
        if entry.endswith("</w>") and all(c in of for c in entry[:-4]):
            raw = bytes(of[c] for c in entry[:-4])
            try:
                words.append(raw.decode())
            except UnicodeDecodeError:
                continue
    found = Tokenizer.from_str(spec).encode_batch(words, add_special_tokens=False)
    return [w.encode() for w, e in zip(words, found, strict=True) if len(e.ids) == 1 and w == lowered(w)]


def lowered(text: str) -> str:
    """NFC, then lower case of each character by itself (a final sigma is no special case)."""
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


def pretokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of each match of the tokenizer's pattern, and the n+1 offsets of rows into them."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    starts, ends, kind, final = runs(buf, offs)
    begins = np.zeros(len(buf) + 1, bool)
    begins[starts] = True
    number = np.zeros(len(buf) + 1, np.int8)
    at = kind == NUMBER
    number[starts[at]] += 1
    number[ends[at]] -= 1
    begins[:-1] |= (np.cumsum(number)[:-1] > 0) & ((buf & 0xC0) != 0x80)
    run, take = contracted(buf, starts, ends, kind, final, np.ones(len(starts), bool))
    begins[starts[run]] = False
    begins[starts[run] + take] = True
    begins[offs[:-1][np.diff(offs) > 0]] = True
    begins[-1] = False
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(buf))
    space = np.zeros(len(buf), bool)
    space[starts[kind == SPACE]] = True
    keep = ~space[first]
    return first[keep], last[keep], np.searchsorted(first[keep], offs)


class Counter:
    def __init__(self, spec: str, whole: list[bytes]):
        from tokenizers import Tokenizer

        self.tokenizer, self.letters = Tokenizer.from_str(spec), byte_letters()
        self.special = [t["content"] for t in json.loads(spec)["added_tokens"]]
        ends = np.cumsum([len(w) for w in whole])
        self.whole = np.frombuffer(b"".join(whole), np.uint8), ends - [len(w) for w in whole], ends
        self.forget()

    def forget(self) -> None:
        self.met = Met(1 << (2 * KNOWN - 1).bit_length())
        keys, first = np.unique(spans_hash(*self.whole) | np.uint64(1), return_index=True)
        self.met.add(self.whole[0], self.whole[1][first], self.whole[2][first], keys)
        self.n = np.ones(len(self.met.at), np.int32)

    def _merged(self, piece: bytes) -> int:
        return len(self.tokenizer.model.tokenize("".join(map(self.letters.__getitem__, piece))))

    def _pieces(self, text: str) -> tuple[list[str], int]:
        """The text around its special strings, and how many there are; the leftmost is taken first."""
        n, parts = 0, [text]
        if "<|" in text:
            for s in self.special:
                parts = [x for p in parts for x in p.split(s)]
            n = len(parts) - 1
        return parts, n

    def counts(self, texts: list[str | None]) -> np.ndarray:
        special, raw, owner = np.zeros(len(texts), np.int64), [], []
        for i, text in enumerate(texts):
            if text:
                parts, special[i] = self._pieces(text)
                raw += [lowered(p).encode() for p in parts]
                owner += [i] * len(parts)
        buf = np.frombuffer(b"".join(raw), np.uint8)
        offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        starts, ends, at = pretokens(buf, offs)
        keys = spans_hash(buf, starts, ends) | np.uint64(1)
        which = self.met.find(buf, starts, ends, keys)
        new = np.flatnonzero(which == -1)
        if len(new):
            fresh, first = np.unique(keys[new], return_index=True)
            first, met = new[first], self.met.n
            if met > len(self.whole[1]) and met + len(fresh) > KNOWN:
                self.forget()
                return self.counts(texts)
            if met + len(fresh) > len(self.n):
                self.n = np.concatenate([self.n, np.zeros(met + len(fresh) - len(self.n), np.int32)])
            self.n[met : met + len(fresh)] = [self._merged(bytes(buf[starts[i] : ends[i]])) for i in first]
            self.met.add(buf, starts[first], ends[first], fresh)
            which[new] = self.met.find(buf, starts[new], ends[new], keys[new])
        n = self.n[which]
        for i in np.flatnonzero(which < 0).tolist():  # another pre-token has the same hash
            n[i] = self._merged(bytes(buf[starts[i] : ends[i]]))
        total = np.concatenate([[0], np.cumsum(n)])
        np.add.at(special, np.array(owner, np.int64), total[at[1:]] - total[at[:-1]])
        return special


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of docs (doc_id, text)."""
    with open(path or default_path(), encoding="utf-8") as file:
        spec = file.read()
    shared = small_batches(docs).sparkSession.sparkContext.broadcast((spec, whole_tokens(spec)))

    def run(batches):
        counter = Counter(*shared.value)
        for batch in batches:
            _, offs = text_rows(batch.column(1))
            n = []
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(offs, offs[at] + SLICE_BYTES, "right")) - 1)
                n.append(counter.counts(batch.column(1).slice(at, to - at).to_pylist()))
                at = to
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offs)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
