"""Reference database folders: where they are looked for, what they hold, how they are bundled."""

from __future__ import annotations

import os
import tarfile
from datetime import datetime, timezone
from pathlib import Path

from ..sources.readers import read_manifest
from ..sources.writers import bundle, sha256_of

MANIFEST = "manifest.json"
VARIABLE = "SPORELIGHT_DATABASE"


# Files that mark a folder without a manifest as a database, and those it must hold besides.
MARKERS = ("vrl_genbank.info.gz", "vrl_idmapping.gz")
REFERENCES = ("vrl_plant", "vrl_plant_prot")


def _conda() -> str | None:
    prefix = os.environ.get("CONDA_PREFIX")
    return str(Path(prefix) / "share/sporelight/database") if prefix else None


def user_folder() -> Path:
    return Path.home() / ".local/share/sporelight/database"


def candidates(given: str | None = None) -> list[Path]:
    """Folders in the order they are tried: the one given, the environment's, the working folder's, conda's, the user's."""
    named = [given, os.environ.get(VARIABLE), "database", _conda(), str(user_folder())]
    return [Path(p) for p in named if p]


def install_target(given: str | None = None) -> Path:
    """Where a database is installed: the place given, conda's if there is one, else the user's."""
    return Path(given or _conda() or user_folder())


def reference_path(folder: Path, name: str) -> Path:
    """A reference by path or by name below the database; it must exist."""
    for place in (Path(name), folder / name):
        if place.exists():
            return place.resolve()
    raise FileNotFoundError(f"no reference {name} in {folder}")


def problems(folder: Path) -> dict[str, list[str]]:
    """What is wrong with a database, by section; empty if nothing is."""
    if not folder.is_dir():
        return {"database": [f"missing directory: {folder}"]}
    if (folder / MANIFEST).is_file():
        try:
            files = read_manifest(str(folder / MANIFEST)).get("files")
        except ValueError as e:
            return {"manifest": [str(e)]}
        if not isinstance(files, list):
            return {"manifest": [f"no list of files: {folder / MANIFEST}"]}
        missing = [f for f in files if not (folder / f).is_file()]
    else:
        missing = [f for f in (*MARKERS, *REFERENCES) if not (folder / f).exists()]
    return {"files": missing} if missing else {}


def download(url: str, target: Path, sha256: str | None = None, sha256_url: str | None = None) -> Path:
    """Fetch an archive (and its checksum) by any address the machine reaches, and install it."""
    import tempfile
    import urllib.request

    with tempfile.TemporaryDirectory() as folder:  # on the machine of the command line, never on a cluster's
        archive = str(Path(folder) / "database.tar.gz")
        urllib.request.urlretrieve(url, archive)
        if sha256_url:
            urllib.request.urlretrieve(sha256_url, archive + ".sha256")
        elif sha256:
            Path(archive + ".sha256").write_text(sha256 + "\n", encoding="utf-8")
        return install(archive, target)


def resolve(given: str | None = None, markers: tuple[str, ...] = MARKERS) -> tuple[Path, str]:
    """First candidate that is a database, and its kind (``manifest`` or ``legacy``)."""
    for folder in candidates(given):
        if kind := kind_of(folder, markers):
            return folder, kind
    raise FileNotFoundError(f"no database in {', '.join(map(str, candidates(given)))}")


def kind_of(folder: Path, markers: tuple[str, ...] = ()) -> str | None:
    if (folder / MANIFEST).is_file():
        return "manifest"
    return "legacy" if markers and all((folder / m).exists() for m in markers) else None


def file_of(folder: Path, name: str) -> Path:
    """An absolute path as it is, else below the database."""
    return Path(name) if Path(name).is_absolute() else folder / name


def files_in(folder: Path) -> list[str]:
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and p.name != MANIFEST)


def manifest_of(folder: Path, name: str, version: str, source_kind: str) -> dict:
    return {"format": "sporelight-database", "manifest_version": 2, "db_name": name, "db_version": version, "source_kind": source_kind, "created_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"), "files": files_in(folder)}


def missing_files(folder: Path) -> list[str]:
    return [f for f in read_manifest(str(folder / MANIFEST)).get("files", []) if not (folder / f).is_file()]


def make_bundle(folder: Path, archive: str, name: str, version: str, source_kind: str = "legacy") -> str:
    return bundle(str(folder), archive, manifest_of(folder, name, version, source_kind))


def expected_sha256(path: str) -> str:
    return Path(path).read_text(encoding="utf-8").split()[0].lower()


def install(archive: str, target: Path) -> Path:
    """Unpack a bundle whose checksum fits; members that are links or point outside are refused."""
    if Path(archive + ".sha256").exists() and expected_sha256(archive + ".sha256") != sha256_of(archive):
        raise ValueError(f"checksum of {archive} doesn't fit")
    target.mkdir(parents=True, exist_ok=True)
    with tarfile.open(archive) as tar:
        for m in tar.getmembers():
            inside = (target / m.name).resolve().is_relative_to(target.resolve())
            if m.issym() or m.islnk() or not inside:
                raise ValueError(f"refused member of {archive}: {m.name}")
        tar.extractall(target, filter="data")
    found = [p.parent for p in target.rglob(MANIFEST)]
    if not found:
        raise ValueError(f"no database in {archive}")
    return min(found, key=lambda p: len(p.parts))
