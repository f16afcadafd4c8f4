"""Invented prose."""

from __future__ import annotations

import random

WORDS = [f"{a}{b}{c}" for a in ("ba", "to", "ri", "mel", "su") for b in ("no", "ke", "vi", "") for c in ("ta", "lo", "n")]


def prose(seed: int, n: int) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=n))
