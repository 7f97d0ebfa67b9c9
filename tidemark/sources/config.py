"""Reference and motif configuration files (small, read on the driver)."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from pathlib import Path

#: Letters of reference and motif sequences, and the pattern of a motif's header.
RESIDUES = frozenset("ACDEFGHIKLMNPQRSTVWYX*")
_MOTIF = re.compile(r"motif_reference[\s_\-:.]*(\S*)", re.I)


@dataclass
class Motif:
    tag: str
    parts: list[str]

    @property
    def seq(self) -> str:
        return "".join(self.parts)


@dataclass
class Config:
    protein: str | None = None
    motifs: list[Motif] = field(default_factory=list)


def entries(text: str) -> list[tuple[str, str]]:
    """Header and joined sequence lines of each section."""
    out: list[tuple[str, list[str]]] = []
    for line in map(str.strip, text.splitlines()):
        if line.startswith(">"):
            out.append((line[1:].strip(), []))
        elif line and out:
            out[-1][1].append(line)
    return [(h, re.sub(r"\s", "", "".join(b)).upper()) for h, b in out]


def checked(seq: str, what: str) -> str:
    if odd := sorted(set(seq) - RESIDUES):
        raise ValueError(f"{what} has letters that are no residues: {' '.join(odd)}")
    return seq


def parse(text: str) -> Config:
    """A validated configuration: at most one protein, any number of motifs (parts joined by +) with distinct tags.

    A motif header is told before a protein header, so a tag may contain the word protein. Empty sections are skipped."""
    found = Config()
    raw: list[tuple[str, list[str]]] = []
    for header, seq in entries(text):
        if not seq:
            continue
        if m := _MOTIF.fullmatch(header):
            parts = [checked(p, f"motif {header!r}") for p in seq.split("+") if p]
            if not parts:
                raise ValueError(f"motif {header!r} has no parts")
            raw.append((re.sub(r"[^A-Za-z0-9_\-]", "_", m[1]), parts))
        elif "protein" in header.lower():
            if found.protein is not None:
                raise ValueError("more than one protein reference")
            found.protein = checked(seq, "protein reference")
        else:
            raise ValueError(f"unknown section {header!r}")
    for k, (tag, parts) in enumerate(raw, 1):
        tag = tag or ("motif" if len(raw) == 1 else f"motif{k}")
        if tag in {m.tag for m in found.motifs}:
            raise ValueError(f"motif tag {tag!r} occurs twice")
        found.motifs.append(Motif(tag, parts))
    if found.protein is None and not found.motifs:
        raise ValueError("neither a protein nor a motif reference")
    return found


def parse_loosely(text: str) -> tuple[str, dict[str, str]]:
    """Gap-free protein and motifs by tag (+ stays), without checks; headers in exact case."""
    protein, motifs = "", {}
    for header, seq in entries(text):
        seq = seq.translate({ord(c): None for c in "-. "})
        if header.startswith("protein_reference"):
            protein = seq
        elif header.startswith("motif_reference"):
            motifs[header.removeprefix("motif_reference").strip("_ -:.") or "motif"] = seq
    return protein, motifs


def find(folder: str | Path, dataset: str, exists=os.path.isfile) -> str:
    """The dataset's own file, else reference.txt, else config.txt."""
    for name in (f"{dataset}.txt", "reference.txt", "config.txt"):
        if exists(path := f"{str(folder).rstrip('/')}/{name}"):
            return path
    raise FileNotFoundError(f"no configuration for {dataset} in {folder}")


def render(config: Config) -> str:
    lines = [">protein_reference", config.protein] if config.protein else []
    for m in config.motifs:
        lines += [f">motif_reference_{m.tag}", "+".join(m.parts)]
    return "\n".join(lines) + "\n"
