"""Prediction by partial matching, symbol by symbol, in plain Python; shares no code with the operator."""

from __future__ import annotations

import collections
import math

UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def symbols(text, order):
    """(context, symbol) at every byte and at the end; in front of a text stand zero bytes."""
    data = bytes(order) + (text or "").encode().translate(UPPER) + b"\0"
    return [(data[i - order:i], data[i]) for i in range(order, len(data))]


class Model:
    def __init__(self, texts, order):
        self.order = order
        self.after = collections.defaultdict(collections.Counter)
        for text in texts:
            for context, symbol in symbols(text, order):
                for k in range(order + 1):
                    self.after[context[order - k:]][symbol] += 1

    def log10(self, context, symbol):
        out, barred = 0.0, set()
        for k in range(self.order, -1, -1):
            seen = self.after.get(context[self.order - k:])
            if seen is None:
                continue
            room = sum(n for s, n in seen.items() if s not in barred) + len(seen)
            if symbol in seen:
                return out + math.log10(seen[symbol] / room)
            out += math.log10(len(seen) / room)
            barred = set(seen)
        return out - math.log10(max(256 - len(barred), 1))

    def score(self, text):
        return sum(self.log10(c, s) for c, s in symbols(text, self.order))
