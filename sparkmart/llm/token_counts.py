"""Token counts of a sentencepiece BPE model (operator 6): whole-token shortcut.

Offline proof (``prove``, once per worker, from the vocabulary alone):

* no piece holds a space mark after another character, so merges never cross
  a boundary other-character / space mark: a text falls into pre-tokens
  "space marks, then other characters" that are encoded independently;
* a separator character (newline, tab, carriage return) that is in no piece
  but its byte fallback stands alone, so a pre-token falls apart there too;
* every piece that the library encodes alone as exactly one token is listed:
  a pre-token that is listed counts one.

Only the other pre-tokens go through the library's merges, each distinct one
once while it is in the worker's bounded cache. The count equals the
library's for the whole text.

Cases: null counts as empty (0 tokens); special strings are ordinary text
unless the model itself defines them as user symbols (the proof then fails and
whole texts go to the library).
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from sparkmart.llm.common import id_text, map_arrow

MARK = "▁"
SEPARATORS = "\n\t\r"
CACHE_WORDS = 400_000
CACHE_CHARS = 64                 # longer pre-tokens are counted anew, so the cache has a bound in bytes
_COUNTERS: dict[str, "Counter"] = {}


def prove(sp) -> dict:
    """What the shortcut may assume for this model: ``split`` (pre-tokens are
    independent), ``alone`` (separators that always stand alone) and ``whole``
    (the strings after the first mark that encode alone as one token)."""
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    normal = [p for i, p in enumerate(pieces) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]
    plain = sp.encode("a  b ", out_type=str)  # prefix mark added, nothing collapsed
    split = "".join(plain) == f"{MARK}a{MARK}{MARK}b{MARK}" and not any(MARK in p.lstrip(MARK) for p in normal)
    chars = set("".join(normal))
    alone = {}
    for c in SEPARATORS:
        if c not in chars:
            alone[c] = len(sp.encode(c)) - 1  # without the prefix mark
    whole = set()
    if split:
        cand = [p[1:] for p in normal if p.startswith(MARK) and len(p) > 1]
        whole = {w for w, ids in zip(cand, sp.encode(cand)) if len(ids) == 1}
    return {"split": split, "alone": alone, "whole": whole}


class Counter(dict):
    """Pre-token (without its first mark) -> number of tokens; filled on demand."""

    def __init__(self, model: bytes):
        import sentencepiece
        super().__init__()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.facts = prove(self.sp)
        self.alone = self.facts["alone"]
        seps = "".join(self.alone)
        self.seps = re.compile(f"[{re.escape(seps)}]") if seps else None
        self.update(dict.fromkeys(self.facts["whole"], 1))
        self.fixed = len(self)
        self.tail: dict[str, int] = {}
        self.merged = 0

    def __missing__(self, word: str) -> int:
        n = self._count(word)
        if len(word) <= CACHE_CHARS:
            self[word] = n
        return n

    def _count(self, word: str) -> int:
        if self.seps is not None and (m := self.seps.search(word)):
            n = (self[word[:m.start()]] if m.start() else 1)  # a lone mark is one token
            at = m.start()
            while True:
                sep, nxt = word[at], self.seps.search(word, at + 1)
                n += self.alone[sep] + self._after(sep, word[at + 1:nxt.start() if nxt else None])
                if not nxt:
                    return n
                at = nxt.start()
        self.merged += 1
        return len(self.sp.encode(word)) if word else 1

    def _after(self, sep: str, rest: str) -> int:
        """Tokens of what follows a separator, where no mark is put before it."""
        if not rest:
            return 0
        n = self.tail.get(rest)
        if n is None:
            self.merged += 1
            n = len(self.sp.encode(sep + rest)) - 1 - self.alone[sep]
            if len(rest) <= CACHE_CHARS:
                self.tail[rest] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.facts["split"]:
            return len(self.sp.encode(text))
        if len(self) > self.fixed + CACHE_WORDS or len(self.tail) > CACHE_WORDS:
            self.clear()
            self.tail.clear()
            self.update(dict.fromkeys(self.facts["whole"], 1))
        words = text.replace(MARK, " ").split(" ")
        if "" not in words:
            return sum(map(self.__getitem__, words))
        n, run = 0, 0
        for w in words[:-1]:
            if w:
                n += self[MARK * run + w]
                run = 0
            else:
                run += 1
        return n + self[MARK * run + words[-1]]


def counter(model: bytes) -> Counter:
    key = hashlib.sha256(model).hexdigest()
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(model)
    return _COUNTERS[key]


def token_counts(df: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``df``."""
    with open(model_file, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: a fixed size

    def run(cols):
        c = counter(model.value)
        texts = [t or "" for t in cols["text"]]
        n = [c.count(t) for t in texts]
        return {"doc_id": cols["doc_id"], "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n,
                "over_limit": [x > limit for x in n]}

    return map_arrow(id_text(df), run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
