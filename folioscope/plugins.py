"""The four pluggable functions and the defaults that need no model.

A plug-in is any picklable object with the method below.  It is shipped to the tasks; a
``start()`` method, when there is one, runs before the first call, once per stage in each
Python worker process, and is the place to load a model.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections import OrderedDict
from types import ModuleType
from typing import Protocol

import numpy as np


class Extractor(Protocol):
    def extract(self, path: str, content: bytes) -> tuple[str | None, dict[str, str]]:
        """Text (None when there is none) and metadata of one file."""


class Tokenizer(Protocol):
    def encode(self, text: str) -> list: ...

    def decode(self, tokens: list) -> str: ...


class Encoder(Protocol):
    dims: int
    batch_size: int

    def encode(self, texts: list[str]) -> np.ndarray:
        """One vector per text, pooled over its positions."""


class Generator(Protocol):
    def generate(self, prompt: str, model: str, temperature: float) -> str: ...


# Started plug-ins that a worker process keeps; the one unused for longest is let go first.
KEPT = 4


class Shipped:
    """A plug-in on its way to the tasks, under a key by which a process finds it again."""

    def __init__(self, plugin):
        self.key, self.plugin = uuid.uuid4().hex, plugin


def _started() -> OrderedDict[str, object]:
    """Started plug-ins by key.

    The library travels to tasks by value, so its own globals end with a task; an entry of
    ``sys.modules`` lasts as long as the process.
    """
    name = "folioscope_started"
    return vars(sys.modules.setdefault(name, ModuleType(name))).setdefault("kept", OrderedDict())


def start(shipped: Shipped):
    """The plug-in, ready for use: started by the first task of its stage in this process.

    Later tasks get the started object, not their own copy.  When ``start()`` raises, nothing
    is kept and the task fails.
    """
    kept = _started()
    if shipped.key not in kept:
        begin = getattr(shipped.plugin, "start", None)
        if begin is not None:
            begin()
        kept[shipped.key] = shipped.plugin
        while len(kept) > KEPT:
            kept.popitem(last=False)
    kept.move_to_end(shipped.key)
    return kept[shipped.key]


class WhitespaceTokenizer:
    def encode(self, text: str) -> list[str]:
        return text.split()

    def decode(self, tokens: list[str]) -> str:
        return " ".join(tokens)


class HashingEncoder:
    """Each position is a signed unit vector chosen by a hash of its token.

    A text fills as many windows of ``positions`` slots as it needs, and at least one.
    Pooling is the mean over all of their slots, the empty ones included; with ``mask`` only
    the filled ones count.
    """

    _KNOWN_LIMIT = 1 << 20

    def __init__(self, dims: int = 64, positions: int = 512, mask: bool = False):
        self.dims, self.positions, self.mask = dims, positions, mask
        self.batch_size = 1024
        self._known: dict[str, int] = {}

    def _slot(self, token: str) -> int:
        """Twice the dimension, plus one for a negative sign."""
        slot = self._known.get(token)
        if slot is None:
            code = int(hashlib.md5(token.encode()).hexdigest()[:8], 16)
            slot = code % self.dims * 2 + code // self.dims % 2
            if len(self._known) >= self._KNOWN_LIMIT:
                self._known.clear()
            self._known[token] = slot
        return slot

    def encode(self, texts: list[str]) -> np.ndarray:
        rows = [[self._slot(t) for t in text.split()] for text in texts]
        counts = np.array([len(r) for r in rows], dtype=np.int64)
        slots = np.fromiter((s for r in rows for s in r), dtype=np.int64, count=counts.sum())
        cells = np.repeat(np.arange(len(texts)), counts) * self.dims + slots // 2
        sums = np.bincount(cells, weights=1 - 2 * (slots % 2), minlength=len(texts) * self.dims)
        windows = np.maximum(-(-counts // self.positions), 1)
        divisor = np.maximum(counts, 1) if self.mask else self.positions * windows
        return sums.reshape(len(texts), self.dims) / divisor[:, None]
