"""Byte-pair encoding from public vocabulary files: token counts, encoding and decoding.

Reads the json format of the tokenizers library for byte-level vocabularies, with or without a word-end suffix.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from .common import map_texts

#: How byte-level vocabularies split text before merging.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words that a Python worker remembers between batches; the store is emptied when full.
REMEMBERED = 200_000
#: Longer words are encoded anew each time.
LONG_WORD = 64
#: Characters of text whose words are merged together.
CHUNK_CHARS = 4_000_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars, spare = [""] * 256, 0x100
    for b in range(256):
        if b in own:
            chars[b] = chr(b)
        else:
            chars[b], spare = chr(spare), spare + 1
    return chars


class Vocabulary:
    """Symbols, merges and text rules of one file. Pairs are keyed by first id * 2**32 + second id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.byte_decoder = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        made_at: dict[int, int] = {}
        for r, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            new = self.ids[a + b]
            made_at.setdefault(new, r)
            self.rank[self.ids[a] << 32 | self.ids[b]] = r
            self.made.append(new)
        if any(made_at.get(x, -1) >= r for key, r in self.rank.items() for x in (key >> 32, key & 0xFFFFFFFF)):
            raise ValueError("a merge is listed before those that make its parts")
        chars = byte_chars()
        self.of_char = chars
        self.inner = [self.ids.get(c) for c in chars]
        self.final = [self.ids.get(c + self.suffix) for c in chars]
        if None in self.inner or None in self.final:
            raise ValueError("the vocabulary lacks the symbol of a byte")
        self.bytes_of = {c: i for i, c in enumerate(chars)}
        self.lower = self.nfc = False
        pre = spec["pre_tokenizer"]
        if pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            pattern = BYTE_LEVEL_PATTERN
        elif pre["type"] == "Sequence" and [p["type"] for p in pre["pretokenizers"]] == ["Split", "ByteLevel"] and pre["pretokenizers"][0]["invert"]:
            pattern = pre["pretokenizers"][0]["pattern"]["Regex"]
        else:
            raise ValueError("unknown way to split text")
        for step in (spec.get("normalizer") or {"normalizers": []})["normalizers"]:
            if step["type"] == "NFC":
                self.nfc = True
            elif step["type"] == "Lowercase":
                self.lower = True
            elif step["type"] != "Replace" or step["pattern"] != {"Regex": r"\s+"}:  # white space is dropped by the split
                raise ValueError("unknown normalisation")
        self.split = regex.compile(pattern).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None

    def segments(self, text: str):
        """(is special, piece) of a text; the library finds special strings in the text as given."""
        if self.cut is None or not any(s in text for s in self.special):
            yield False, text
            return
        for i, piece in enumerate(self.cut(text)):
            if piece:
                yield bool(i % 2), piece

    def words(self, piece: str) -> list[str]:
        if self.nfc and not unicodedata.is_normalized("NFC", piece):
            piece = unicodedata.normalize("NFC", piece)
        if self.lower:  # letter by letter, without the rule for a final sigma
            piece = piece.replace("Σ", "σ").lower()
        return self.split(piece)

    def symbols(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        out = [self.inner[b] for b in data]
        if out:
            out[-1] = self.final[data[-1]]
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merged_length(symbols: list[int], rank: dict[int, int], made: list[int]) -> int:
    """Symbols that remain: a heap of adjacent pairs over a linked list, lowest rank and leftmost first."""
    n = len(symbols)
    queue = []
    for i in range(n - 1):
        r = rank.get(symbols[i] << 32 | symbols[i + 1])
        if r is not None:
            queue.append(r << 32 | i)
    if not queue:
        return n
    heapq.heapify(queue)
    after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
    pop, push, get = heapq.heappop, heapq.heappush, rank.get
    while queue:
        x = pop(queue)
        r, i = x >> 32, x & 0xFFFFFFFF
        j = after[i]
        if symbols[i] < 0 or j >= n or get(symbols[i] << 32 | symbols[j]) != r:
            continue
        merges += 1
        new = symbols[i] = made[r]
        symbols[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = get(new << 32 | symbols[k])
            if r is not None:
                push(queue, r << 32 | i)
        h = before[i]
        if h >= 0:
            r = get(symbols[h] << 32 | new)
            if r is not None:
                push(queue, r << 32 | h)
    return n - merges


class _Lengths(dict):
    """Word to its number of tokens, found on first use."""

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.v = v

    def __missing__(self, word):
        n = merged_length(self.v.symbols(word), self.v.rank, self.v.made)
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


@lru_cache(maxsize=4)
def _lengths(path: str) -> _Lengths:
    return _Lengths(vocabulary(path))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every whole text.

    Each word's pairs go on a heap by rank, over a linked list of its symbols; the count is the initial symbols
    less the merges. One pass without a shuffle; a word's count is remembered per Python worker (bounded).
    Null counts as empty (0 tokens). A special string in a text is one token. path must exist on each executor.
    Rows are independent: repeated rows repeat, other columns are ignored, an empty table gives none.
    """

    def count(texts):
        v, length = vocabulary(path), _lengths(path).__getitem__
        n_bytes, n_tokens = [], []
        for text in texts:
            text = text or ""
            n_bytes.append(len(text.encode("utf-8")))
            n_tokens.append(sum(1 if special else sum(map(length, v.words(piece))) for special, piece in v.segments(text)))
        return {"n_bytes": n_bytes, "n_tokens": n_tokens, "over_limit": [n > limit for n in n_tokens]}

    return map_texts(docs, id_col, text_col, "n_bytes long, n_tokens long, over_limit boolean", count)


def encode_words(words: list[str], v: Vocabulary) -> list[list[int]]:
    """Token ids of each word: an index of all positions of each pair, ranks applied in ascending order.

    The words' symbols lie in one list, linked within each word. Applying a rank visits its positions only and adds
    the pairs that arise to the lists of their (always higher) ranks.
    """
    symbols: list[int] = []
    after: list[int] = []
    before: list[int] = []
    starts = []
    for word in words:
        own = v.symbols(word)
        at = len(symbols)
        starts.append(at)
        symbols += own
        after += range(at + 1, at + len(own) + 1)
        before += range(at - 1, at + len(own) - 1)
        if own:
            after[-1] = before[at] = -1
    rank, made = v.rank, v.made
    places: dict[int, list[int]] = {}
    for i, j in enumerate(after):
        if j >= 0:
            r = rank.get(symbols[i] << 32 | symbols[j])
            if r is not None:
                places.setdefault(r, []).append(i)
    active = list(places)
    heapq.heapify(active)
    while active:
        r = heapq.heappop(active)
        new = made[r]
        for i in sorted(places.pop(r)):
            j = after[i]
            if symbols[i] < 0 or j < 0 or rank.get(symbols[i] << 32 | symbols[j]) != r:
                continue  # one of the two went into an earlier merge
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            h = before[i]
            if k >= 0:
                before[k] = i
                up = rank.get(new << 32 | symbols[k])
                if up is not None:
                    if up not in places:
                        places[up] = []
                        heapq.heappush(active, up)
                    places[up].append(i)
            if h >= 0:
                up = rank.get(symbols[h] << 32 | new)
                if up is not None:
                    if up not in places:
                        places[up] = []
                        heapq.heappush(active, up)
                    places[up].append(h)
    starts.append(len(symbols))
    return [[s for s in symbols[a:b] if s >= 0] for a, b in zip(starts, starts[1:])]


def decode(ids, v: Vocabulary) -> str:
    """Text of token ids, special ones included; without a decoder in the file, the tokens joined by spaces."""
    tokens = [v.tokens[i] for i in ids]
    if not v.byte_decoder:
        return " ".join(tokens)
    return b"".join(bytes(v.bytes_of[c] for c in t) if all(c in v.bytes_of for c in t) else t.encode("utf-8") for t in tokens).decode("utf-8", "replace")


class Codec:
    """Encodes texts chunk by chunk; words of a chunk that aren't remembered are merged together."""

    def __init__(self, v: Vocabulary):
        self.v, self.known = v, {}

    def learn(self, pieces: list[list[str]]) -> list[str]:
        """Encodes the words that aren't known; returns those too long to be kept after the chunk."""
        new = list(set().union(*pieces).difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(set().union(*pieces))
        for word, ids in zip(new, encode_words(new, self.v)):
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
        return [w for w in new if len(w) > LONG_WORD]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        v, out, at = self.v, [], 0
        while at < len(texts):
            chunk, chars = [], 0
            while at < len(texts) and (not chunk or chars + len(texts[at]) <= CHUNK_CHARS):
                chars += len(texts[at])
                chunk.append([(special, piece if special else v.words(piece)) for special, piece in v.segments(texts[at])])
                at += 1
            long_words = self.learn([words for parts in chunk for special, words in parts if not special])
            get = self.known.__getitem__
            for parts in chunk:
                out.append(b"".join(struct.pack("<I", v.special[x]) if special else b"".join(map(get, x)) for special, x in parts))
            for word in long_words:
                del self.known[word]
        return out


@lru_cache(maxsize=4)
def _codec(path: str) -> Codec:
    return Codec(vocabulary(path))


def ids_of(data: bytes) -> tuple:
    return struct.unpack(f"<{len(data) // 4}I", data)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of long) of every whole text, special strings as their ids, nothing added.

    Letters, case and composition follow the installed Unicode tables; code points that these and the library's own
    tables date differently (assigned after Unicode 15.1) may be split otherwise. Null counts as empty (no ids). One pass without a shuffle; memory is bounded by CHUNK_CHARS or one text, and by
    the remembered words. Repeated rows repeat, other columns are ignored, an empty table gives none.
    """
    return map_texts(docs, id_col, text_col, "ids array<long>", lambda texts: {"ids": [list(ids_of(b)) for b in _codec(path).encode([t or "" for t in texts])]})


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every array of ids, as the library decodes without skipping special tokens. Null counts as none."""
    return map_texts(encoded, id_col, ids_col, "text string", lambda rows: {"text": [decode(ids or (), vocabulary(path)) for ids in rows]})


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: encodes, then decodes from the ids, in one pass.

    The digests are of what encode_texts and decode_ids give; ids and texts needn't leave the executors for them.
    """
    def digests(texts):
        v = vocabulary(path)
        codes = _codec(path).encode([t or "" for t in texts])
        return {
            "n_tokens": [len(b) // 4 for b in codes],
            "ids_sha256": [hashlib.sha256(b).hexdigest() for b in codes],
            "decoded_sha256": [hashlib.sha256(decode(ids_of(b), v).encode("utf-8")).hexdigest() for b in codes],
        }

    return map_texts(docs, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)
