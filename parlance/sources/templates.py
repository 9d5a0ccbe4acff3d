"""Prompt templates from files, read on the driver before any work begins."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass


def read_template(path: str, needs: tuple[str, ...] = ()) -> str:
    """The UTF-8 text of a template; raises FileNotFoundError without the file, ValueError if it lacks one of the
    names it needs as {name}."""
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no template {path}")
    with open(path, encoding="utf-8") as f:
        text = f.read()
    missing = [n for n in needs if n not in re.findall(r"\{(\w+)\}", text)]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return text


def read_profile(folder: str, outputs: list[str], suffix: str = ".txt") -> list[tuple[str, str]]:
    """(output name, template) for each output of a profile, from <folder>/<stem of the output><suffix>, in the
    given order."""
    return [(name, read_template(os.path.join(folder, os.path.splitext(name)[0] + suffix), ("chunk_summaries",))) for name in outputs]


@dataclass(frozen=True)
class Prompts:
    """What a profile says to the model: system texts of both stages, the template of a chunk, those of the outputs."""

    chunk_system: str
    reduce_system: str
    chunk: str
    outputs: list[tuple[str, str]]


def read_prompts(folder: str, profile: str, outputs: list[str]) -> Prompts:
    """The prompts of a profile from <folder>/<profile>: chunk_system.txt, reduce_system.txt, chunk_prompt.txt and a
    template for each output. A missing one raises FileNotFoundError before any call is made."""
    here = os.path.join(folder, profile)
    if not os.path.isdir(here):
        raise FileNotFoundError(f"no prompts in {here}")
    system = [read_template(os.path.join(here, f"{k}_system.txt")).strip() for k in ("chunk", "reduce")]
    return Prompts(*system, read_template(os.path.join(here, "chunk_prompt.txt"), ("chunk_text",)), read_profile(here, outputs))
