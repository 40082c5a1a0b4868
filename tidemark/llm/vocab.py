"""Vocabulary files of byte-level BPE models, read once by the driver."""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa


def byte_letters() -> list[str]:
    """The letter that stands for each byte in such files: itself if it prints, else one from 256 on."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(others)) for b in range(256)]


@dataclass(frozen=True)
class Vocab:
    """Entries by id, merges as pairs of ids with the id they make, and strings that are tokens of their own."""

    ids: dict[str, int]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]
    suffix: str


def load(path: str) -> Vocab:
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model = file["model"]
    if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
        raise ValueError(f"{path}: a plain BPE model is needed")
    ids = model["vocab"]
    pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    return Vocab(ids, merges, special, model.get("end_of_word_suffix") or "")


def texts(column: pa.Array) -> list[str]:
    """The batch's texts, null as empty."""
    return [t or "" for t in column.to_pylist()]
