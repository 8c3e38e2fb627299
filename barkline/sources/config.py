"""Library preparations and run settings from INI files; command-line values come second."""

from __future__ import annotations

import configparser
import os
from dataclasses import dataclass

from barkline.operators.preprocess import Prep

#: The keys that a preparation must have, all of them and no others.
PREP_KEYS = {"INPUT_READS", "OUTPUT_READS", "UMI_LOCS", "UMI_LENS", "UMI_POS", "SPACER", "SPACER_SEQ", "UMI_INLINE"}

#: The preparations known by name.
PREPS = {
    p.name: p
    for p in (
        Prep("HALOPLEX", 3, 2, (2,), (10,), (1,)),
        Prep("SURESELECT", 3, 2, (2,), (10,), (1,)),
        Prep("EPIC-DS", 2, 2, (1, 2), (12, 12), (1, 1), "TGACT", True),
        Prep("SIMSENSEQ-PE", 2, 2, (1,), (12,), (1,), "ATGGGAAAGAGTGTCC", True),
        Prep("SIMSENSEQ-SE", 1, 1, (1,), (12,), (1,), "ATGGGAAAGAGTGTCC", True),
    )
}

#: Words that mean true.
TRUE_WORDS = {"yes", "true", "t", "y", "1"}
FALSE_WORDS = {"no", "false", "f", "n", "0"}


def as_bool(value: str | bool) -> bool:
    word = str(value).strip().lower()
    if word not in TRUE_WORDS | FALSE_WORDS:
        raise ValueError(f"{value!r} is neither true nor false")
    return word in TRUE_WORDS


def _ints(text: str) -> tuple[int, ...]:
    return tuple(int(x) for x in text.split(","))


def read_prep(name: str, path: str | None = None) -> Prep:
    """A preparation by name; from the section of an INI file where one is given."""
    if path is None:
        if name.upper() not in PREPS:
            raise ValueError(f"{name} is not one of {', '.join(PREPS)}")
        return PREPS[name.upper()]
    ini = configparser.ConfigParser()
    if not ini.read(path):
        raise FileNotFoundError(path)
    sections = {s.upper(): s for s in ini.sections()}
    if name.upper() not in sections:
        raise ValueError(f"{path} has no section {name}")
    got = {k.upper(): v for k, v in ini[sections[name.upper()]].items()}
    if set(got) != PREP_KEYS:
        raise ValueError(f"keys of {name}: missing {sorted(PREP_KEYS - set(got))}, unknown {sorted(set(got) - PREP_KEYS)}")
    spacer = got["SPACER_SEQ"] if as_bool(got["SPACER"]) else None
    if spacer is not None and spacer.lower() == "none":
        raise ValueError(f"{name} has a spacer without a sequence")
    locs, lens, pos = (_ints(got[k]) for k in ("UMI_LOCS", "UMI_LENS", "UMI_POS"))
    # one length or position holds for all locations
    lens, pos = (x * len(locs) if len(x) == 1 else x for x in (lens, pos))
    return Prep(name.upper(), int(got["INPUT_READS"]), int(got["OUTPUT_READS"]), locs, lens, pos, spacer, as_bool(got["UMI_INLINE"]))


@dataclass(frozen=True)
class Settings:
    """Thresholds of a run."""

    distance: int = 1
    position: int = 10
    sizes: tuple[int, ...] = (1, 2, 5)
    count: int = 1
    percent: float = 50.0
    ref: float = 95.0
    alt: float = 2.0
    filter: int = 10
    quality: int = 25


#: Sections and keys of the settings.
SETTING_KEYS = {
    "distance": ("SETTINGS", "umi_edit_distance_threshold", int), "position": ("SETTINGS", "umi_family_pos_threshold", int),
    "sizes": ("SETTINGS", "min_family_sizes", _ints), "count": ("SETTINGS", "count_consensus_threshold", int),
    "percent": ("SETTINGS", "percent_consensus_threshold", float), "ref": ("REPORT", "percent_ref_threshold", float),
    "alt": ("REPORT", "percent_alt_threshold", float), "filter": ("REPORT", "filter_threshold", int),
}
PATH_KEYS = ("bam_file", "reference_file", "outdir", "prep_file")


def read_config(path: str | None) -> configparser.ConfigParser:
    ini = configparser.ConfigParser()
    if path and not ini.read(path):
        raise FileNotFoundError(path)
    return ini


def settings(path: str | None = None, **given: object) -> Settings:
    """The configuration's values, then those given, then the defaults; shares must be 0 to 100."""
    ini, found = read_config(path), {}
    for name, (section, key, kind) in SETTING_KEYS.items():
        if ini.has_option(section, key):
            found[name] = kind(ini.get(section, key))
        elif given.get(name) is not None:
            found[name] = kind(str(given[name])) if kind is _ints and isinstance(given[name], str) else given[name]
    if given.get("quality") is not None:
        found["quality"] = given["quality"]
    out = Settings(**found)
    for name in ("percent", "ref", "alt"):
        if not 0 <= getattr(out, name) <= 100:
            raise ValueError(f"{name} must be from 0 to 100")
    return out


def path_of(config: str | None, key: str, given: str | None = None, needed: bool = True) -> str | None:
    """A path of the configuration, else the one given; outdir is the working folder by default."""
    ini = read_config(config)
    found = ini.get("PATHS", key) if ini.has_option("PATHS", key) else given
    if found is None and key == "outdir":
        return os.getcwd()
    if found is None and needed:
        raise ValueError(f"{key} is missing")
    return found
