"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring(rows: list[tuple[int, str]], k: int = 20) -> dict[int, tuple[int, int, str]]:
    """doc_id -> n_words, n_removed, kept text; ids are unique."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - k + 1):
            window = tuple(words[i:i + k])
            if window in seen:
                gone.update(range(i, i + k))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc] = len(words), len(gone), sha(kept)
    return out
