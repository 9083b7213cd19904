"""Byte-level BPE on the workers: pre-tokens, cached encoding, exact joins.

The encoder takes its vocabulary, merges and splitting rule from a public
``tokenizers`` file.  Text is cut into pre-tokens by the file's own rule and
each pre-token is encoded by the file's own BPE model, so the ids are the
library's; this module adds caches around that and the tree concatenation
of long unsplit stretches.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

# Fixed value: the splitting pattern of byte-level BPE files ("use_regex"),
# written with the standard library's classes.  Used only for texts made of
# the characters of _PLAIN, on which both spellings agree.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
# Any character outside: controls counted as spaces by Python only, digits
# and letters outside Latin, spaces outside ASCII.
_ODD = re.compile("[^\x00-\x1b\x20-\x7fÀ-ɏ‐-‧‰-⁞€]")

CACHE_ENTRIES = 400_000      # per generation; two generations are kept
CACHED_CHARS = 64            # longer pre-tokens are not cached
UNSPLIT_CHARS = 1024         # longer pre-tokens are encoded by halves
LEAF_CHARS = 512             # leaves of that tree


class Cache(dict):
    """Bounded dict: when full, the entries become the old generation and
    the previous old generation is forgotten.  ``make(key)`` fills misses.
    A worker process serves one operator after another, so only the cache in
    use keeps its entries."""

    in_use: "Cache | None" = None

    def __init__(self, make, entries: int = CACHE_ENTRIES, fixed: dict | None = None):
        super().__init__()
        self.make, self.entries, self.old, self.fixed = make, entries, {}, fixed or {}

    @classmethod
    def release(cls) -> None:
        """Forget the entries of the cache in use; operators that use none
        call this, so that they need not share a worker's memory with one."""
        if cls.in_use is not None:
            cls.in_use.clear()
            cls.in_use.old = {}
            cls.in_use = None

    def __missing__(self, key):
        value = self.fixed.get(key)
        if value is not None:
            return value
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > CACHED_CHARS:
                return value
        self[key] = value
        return value

    def trim(self) -> None:
        """Called between documents, never while a lookup loop runs."""
        if Cache.in_use is not self:
            Cache.release()
            Cache.in_use = self
        if len(self) > self.entries:
            self.old = dict(self)
            self.clear()


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 characters stand for themselves, the
    other bytes take the code points from 256 upwards in byte order."""
    own = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Encoder:
    """Worker-side encoder for one byte-level BPE file."""

    def __init__(self, path: str):
        import json
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        pre = spec.get("pre_tokenizer") or {}
        plain_added = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])
                          for t in spec["added_tokens"])
        if (spec["model"]["type"] != "BPE" or spec.get("normalizer") or not plain_added
                or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True)
                or pre.get("add_prefix_space")):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.pre = self.tokenizer.pre_tokenizer
        alphabet = byte_alphabet()
        self.to_alphabet = {b: c for b, c in enumerate(alphabet)}
        to_byte = {c: b for b, c in enumerate(alphabet)}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token = [""] * (max(vocab.values()) + 1)
        for text, i in vocab.items():
            self.token[i] = text
        self.token_bytes = [bytes(to_byte[c] for c in t) if all(c in to_byte for c in t)
                            else t.encode() for t in self.token]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        parts = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, parts)) + ")") if parts else None
        self.digits = [str(i) for i in range(len(self.token))]
        self.ids_of = Cache(self.encode_pretoken)

    # -- pre-tokens ---------------------------------------------------------
    def segments(self, text: str):
        """(stretch, id) parts: the id of an added token, or None for text."""
        if self.added_pattern is None or not any(a in text for a in self.added):
            return [(text, None)] if text else []
        return [(p, self.added.get(p)) for p in self.added_pattern.split(text) if p]

    def pretokens(self, stretch: str) -> list[str]:
        """The pre-tokens of a stretch without added tokens, in order."""
        if not _ODD.search(stretch):
            return _SPLIT.findall(stretch)
        return [stretch[a:b] for _, (a, b) in self.pre.pre_tokenize_str(stretch)]

    # -- encoding -----------------------------------------------------------
    def mapped(self, pretoken: str) -> str:
        if pretoken.isascii() and pretoken.isprintable():      # all but the blank stand for themselves
            return pretoken.replace(" ", self.to_alphabet[32])
        return pretoken.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.to_alphabet)

    def tokenize(self, mapped: str) -> list[int]:
        return [t.id for t in self.model.tokenize(mapped)]

    def encode_pretoken(self, pretoken: str) -> bytes:
        mapped = self.mapped(pretoken)
        ids = self.tree(mapped) if len(mapped) > UNSPLIT_CHARS else self.tokenize(mapped)
        return array("I", ids).tobytes()

    def tree(self, mapped: str) -> list[int]:
        """Encode one long pre-token by halves and join the halves."""
        if len(mapped) <= LEAF_CHARS:
            return self.tokenize(mapped)
        middle = len(mapped) // 2
        return self.join(self.tree(mapped[:middle]), self.tree(mapped[middle:]))

    @lru_cache(maxsize=100_000)   # noqa: B019  one encoder lives per worker
    def stable(self, a: int, b: int) -> bool:
        """Whether the tokens a, b side by side encode to themselves."""
        return self.tokenize(self.token[a] + self.token[b]) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Exact encoding of two adjoining stretches of one pre-token.

        A token sequence is the BPE encoding of its text exactly when every
        adjacent pair encodes to itself.  Both sides have that property, so
        only pairs at the join can break it: re-encode a window around it
        and grow the window until its first and last token agree with the
        untouched neighbours on both sides.
        """
        reach = 1
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            window = "".join(map(self.token.__getitem__, left[a:] + right[:b]))
            middle = self.tokenize(window) if window else []
            ok_left = a == 0 or not middle or self.stable(left[a - 1], middle[0])
            ok_right = b == len(right) or not middle or self.stable(middle[-1], right[b])
            if ok_left and ok_right:
                return left[:a] + middle + right[b:]
            reach *= 2

    def encode(self, text: str) -> bytes:
        """Little-endian uint32 ids of a whole text."""
        out = []
        for stretch, added in self.segments(text):
            if added is not None:
                out.append(added.to_bytes(4, "little"))
            else:
                out.extend(map(self.ids_of.__getitem__, self.pretokens(stretch)))
        self.ids_of.trim()
        return b"".join(out)

    def encode_tokens(self, tokens: list[str]) -> bytes:
        """Little-endian uint32 ids of pre-tokens and added tokens in order."""
        out = [self.added[t].to_bytes(4, "little") if t in self.added else self.ids_of[t] for t in tokens]
        self.ids_of.trim()
        return b"".join(out)

    # -- decoding -----------------------------------------------------------
    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """As the library's decode(ids, skip_special_tokens=False)."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; its caches outlive a task."""
    return Encoder(path)


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def ids_text(enc: Encoder, ids: list[int]) -> str:
    """Decimal ids joined by commas."""
    return ",".join(map(enc.digits.__getitem__, ids))
