"""Files of the operators' own formats on any file system that pyarrow opens."""

from __future__ import annotations

import json

import pyarrow.fs as pafs

MANIFEST = "_manifest.json"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for ``file:``, ``hdfs:``, ``s3:``, ``gs:`` or a plain path."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def make_folder(path: str) -> None:
    fs, folder = opened(path)
    fs.create_dir(folder, recursive=True)


def write_manifest(path: str, content: dict) -> None:
    """The list of files that count. It is moved into place whole, after all else is written."""
    fs, folder = opened(path)
    with fs.open_output_stream(f"{folder}/{MANIFEST}.new") as out:
        out.write(json.dumps(content).encode())
    fs.move(f"{folder}/{MANIFEST}.new", f"{folder}/{MANIFEST}")


def read_manifest(path: str) -> dict | None:
    fs, folder = opened(path)
    if fs.get_file_info(f"{folder}/{MANIFEST}").type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as file:
        return json.loads(file.read())


def listed(path: str, endings: tuple[str, ...]) -> list[str]:
    """Files of a folder without a manifest, by name."""
    fs, folder = opened(path)
    found = fs.get_file_info(pafs.FileSelector(folder, recursive=True))
    names = [i.path[len(folder):].lstrip("/") for i in found if i.is_file]
    return sorted(n for n in names if n.endswith(endings))


def remove_files(path: str, names: list[str]) -> None:
    fs, folder = opened(path)
    for name in names:
        if fs.get_file_info(f"{folder}/{name}").type != pafs.FileType.NotFound:
            fs.delete_file(f"{folder}/{name}")
