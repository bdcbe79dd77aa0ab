"""Texts cut where a byte-level BPE tokenizer never joins what is on both sides.

The tokenizer's pattern starts a new pre-token at a space or line feed that
stands between two other characters, and merges never cross pre-tokens. Parts
cut there can be encoded on their own, so a part's result is remembered and
the library only sees parts that a worker has not met yet.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts that a worker remembers before it starts afresh (about 220 MB).
MEMO_PARTS = 1_000_000

_ODD = re.compile(r"\s[ \n]|[ \n]\s")
#: White space that is neither a space nor a line feed; of ASCII alone, which is found faster.
_RARE, _RARE_ASCII = re.compile(r"[^\S \n]"), re.compile(r"[\t\r\x0b\x0c\x1c-\x1f]")
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: A word and the signs behind it are separate pre-tokens (an apostrophe may begin a contraction, and is none of these).
_TAIL = re.compile(r"([^\W\d_]+)([.,!?;:&#*$%|<>()\[\]\"]+)")


def load(path: str):
    """The library's tokenizer, on one thread, once for each process and path."""
    return _load(path)


@functools.lru_cache(maxsize=4)
def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class PartMemo:
    """What ``work`` gives for each part of a text, in order.

    work: list of strings -> list of results, one each. ``whole`` names strings
    (added tokens) whose texts are never cut.
    """

    def __init__(self, work: Callable[[list[str]], list], whole: list[str], most: int = MEMO_PARTS):
        self.work, self.whole, self.most = work, whole, most
        self.spaced: dict[str, object] = {}  # by the part without the space it starts with
        self.plain: dict[str, object] = {}

    def _plain(self, parts: set[str]) -> None:
        new = list(parts.difference(self.plain))
        if new:
            self.plain.update(zip(new, self.work(new), strict=True))

    def _spaced(self, parts: set[str]) -> None:
        """Results of new parts; a word with signs behind it is put together from both."""
        memo, split = self.spaced, {p: m.groups() for p in parts if not p[-1].isalnum() and (m := _TAIL.fullmatch(p))}
        new = list({split[p][0] if p in split else p for p in parts}.difference(memo))
        if new:
            memo.update(zip(new, self.work([x if x.startswith("\n") else " " + x for x in new]), strict=True))
        self._plain({tail for _, tail in split.values()})
        for p, (word, tail) in split.items():
            memo[p] = memo[word] + self.plain[tail]

    def _make_room(self) -> None:
        if len(self.spaced) + len(self.plain) > self.most:
            self.spaced.clear()
            self.plain.clear()

    def joined(self, texts: list[str]) -> list[bytes]:
        """Each text's results put together, for a ``work`` that gives bytes and a memo without ``whole`` strings.

        Arrow splits the texts and numbers their distinct parts, so the memo is asked once for each of these and not for every part.
        """
        self._make_room()
        out, slow, at, heads, rests = [b""] * len(texts), {}, [], [], []
        for i, x in enumerate(texts):
            if not x:
                continue
            s = x.replace("\n", " \n")
            head, _, rest = s.partition(" ")
            if (not rest or x[0].isspace() or x[-1].isspace() or "  " in s or " \n " in s
                    or ((_RARE_ASCII if x.isascii() else _RARE).search(x) and _ODD.search(x))):
                slow[i] = _CUT.split(x)
            else:
                at.append(i)
                heads.append(head)
                rests.append(rest)
        self._plain(set(heads).union(*slow.values()))
        if at:
            lists = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
            numbered = lists.values.dictionary_encode()
            distinct = numbered.dictionary.to_pylist()
            known = list(map(self.spaced.get, distinct))
            self._spaced({p for p, v in zip(distinct, known, strict=True) if v is None})
            known = [self.spaced[p] if v is None else v for p, v in zip(distinct, known, strict=True)]
            results = pa.array(known, pa.large_binary()).take(numbered.indices)
            _, ends, data = results.buffers()
            ends = np.frombuffer(ends, np.int64)[np.asarray(lists.offsets)].tolist()
            data = data.to_pybytes() if data else b""
            for k, i in enumerate(at):
                out[i] = self.plain[heads[k]] + data[ends[k]:ends[k + 1]]
        for i, parts in slow.items():
            out[i] = b"".join([self.plain[p] for p in parts])
        return out

    def batch(self, texts: list[str]) -> list[list]:
        """The parts' results for each text; an empty text has none. Results of ``work`` must add up with +."""
        self._make_room()
        out: list[list] = [[] for _ in texts]
        slow, heads, rests, new = {}, {}, {}, set()
        for i, x in enumerate(texts):
            if not x:
                continue
            if any(w in x for w in self.whole):
                slow[i] = [x]
            elif x[0].isspace() or x[-1].isspace() or _ODD.search(x):
                slow[i] = _CUT.split(x)
            else:
                heads[i], *rests[i] = x.replace("\n", " \n").split(" ")
                new.update(rests[i])
        self._spaced(new.difference(self.spaced))
        self._plain(set(heads.values()).union(*slow.values()))
        spaced = self.spaced.__getitem__
        for i, first in heads.items():
            out[i] = [self.plain[first], *map(spaced, rests[i])]
        for i, parts in slow.items():
            out[i] = [self.plain[p] for p in parts]
        return out


def added(tok) -> list[str]:
    return [t.content for t in tok.get_added_tokens_decoder().values()]


def in_groups(sizes: list[int], most: int = 4_000_000) -> list[slice]:
    """Slices of consecutive rows of about ``most`` bytes, to bound what a batch keeps at once."""
    out, begin, total = [], 0, 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            out.append(slice(begin, i + 1))
            begin, total = i + 1, 0
    if begin < len(sizes):
        out.append(slice(begin, len(sizes)))
    return out
