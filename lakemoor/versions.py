"""Storage versions: names, order, and what a version can hold."""

from __future__ import annotations

#: Storage versions in order; "stable" and "next" stand for one of them.
VERSIONS = ["0.1", "2.0", "2.1", "2.2", "2.3"]
ALIASES = {"stable": "2.1", "next": "2.3"}
DEFAULT = "2.2"
#: The first version that keeps the nulls of blob columns, and the only one that loses those of structs.
BLOBS_FROM, WITHOUT_STRUCT_NULLS = "2.2", "2.0"


def resolve(asked: str | None, blob_columns: list[str]) -> str:
    """The version to write with; ValueError if it is unknown or cannot hold blob columns."""
    name = DEFAULT if asked is None else asked
    version = ALIASES.get(name, name)
    if version not in VERSIONS:
        raise ValueError(f"Unknown storage version: {asked!r}; known are {', '.join([*VERSIONS, *ALIASES])}")
    if blob_columns and VERSIONS.index(version) < VERSIONS.index(BLOBS_FROM):
        raise ValueError(f"blob_columns needs data storage version {BLOBS_FROM} or later: {name} cannot store a blob column's nulls; leave data_storage_version out for the default")
    return version
