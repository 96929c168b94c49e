"""Files opened by tasks of the Python data sources: local paths and the stores pyarrow knows."""

from __future__ import annotations

import fnmatch

from pyarrow import fs as pafs

from ..session import is_local_fs, local_path


def resolve(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path in it) of a local path or a URI."""
    if is_local_fs(path):
        return pafs.LocalFileSystem(), local_path(path)
    return pafs.FileSystem.from_uri(path)


def listed(path: str, pattern: str = "*") -> list[str]:
    """Paths of the files below ``path`` (or the file itself) whose names match, sorted;
    names with a leading ``_`` or ``.`` and what lies in such folders are passed over."""
    fs, at = resolve(path)
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [path]
    found = fs.get_file_info(pafs.FileSelector(at, recursive=True))
    scheme = "" if is_local_fs(path) else path[:path.index("://") + 3]
    out = []
    for f in found:
        parts = f.path[len(at):].strip("/").split("/")
        if f.type == pafs.FileType.File and fnmatch.fnmatch(parts[-1], pattern) and not any(
                p.startswith(("_", ".")) for p in parts):
            out.append(scheme + f.path)
    return sorted(out)


class FolderCommit:
    """Files of one write job: written under a private folder, moved when the job commits."""

    def __init__(self, path: str, overwrite: bool, pattern: str, job: str):
        self.path, self.overwrite, self.pattern, self.job = path.rstrip("/"), overwrite, pattern, job

    @property
    def private(self) -> str:
        return f"{self.path}/_writing-{self.job}"

    def commit(self, names: list[str]) -> None:
        old = []
        fs, at = resolve(self.path)
        if self.overwrite and fs.get_file_info(at).type != pafs.FileType.NotFound:
            old = listed(self.path, self.pattern)
        fs.create_dir(at, recursive=True)
        _, private = resolve(self.private)
        for name in names:
            fs.move(f"{private}/{name}", f"{at}/{name}")
        for f in old:
            fs.delete_file(resolve(f)[1])
        self.abort()
        with fs.open_output_stream(f"{at}/_SUCCESS"):
            pass

    def abort(self) -> None:
        fs, private = resolve(self.private)
        if fs.get_file_info(private).type != pafs.FileType.NotFound:
            fs.delete_dir(private)
