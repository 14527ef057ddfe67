"""Deterministic local model for tests, queries and the bench (no network).

Behaviour (a pure function of the prompt, so SQL can reproduce it):
* md5(prompt) starts with ``f`` -> a non-text answer (a failure);
* starts with ``e`` -> failure "stub model: refused";
* one-line prompt with an empty summary -> empty answer (a failure);
* otherwise ``"[<kind>] " + md5(prompt)[:16]``; the telegram answer also
  names the source when the digest starts with 0-7; the instagram answer
  is padded with blanks (the caller strips).
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd

_SOURCE = re.compile(r"\nSource: ([^\n]*)")


def stub_generate(req: pd.DataFrame) -> pd.DataFrame:
    texts, errors = [], []
    for kind, prompt in zip(req["kind"], req["prompt"]):
        digest = hashlib.md5(prompt.encode("utf-8")).hexdigest()
        if digest[0] == "f":
            texts.append(0)
            errors.append(None)
            continue
        if digest[0] == "e":
            texts.append(None)
            errors.append("stub model: refused")
            continue
        if kind == "one_line" and "\nSummary: \n" in prompt:
            texts.append("")
            errors.append(None)
            continue
        text = f"[{kind}] {digest[:16]}"
        if kind == "telegram" and digest[0] in "01234567":
            m = _SOURCE.search(prompt)
            text += " " + (m.group(1) if m else "")
        if kind == "instagram":
            text = "  " + text + " \n"
        texts.append(text)
        errors.append(None)
    return pd.DataFrame({"text": pd.Series(texts, dtype=object), "error": errors})
