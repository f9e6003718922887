"""Files in the shared folder, opened from tasks by their URI."""

from __future__ import annotations

from pyarrow import fs


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (file, s3, gs, hdfs; a bare path is a local one) and the path in it."""
    return fs.FileSystem.from_uri(uri)


class Committed:
    """A file written under a temporary name; ``commit`` gives it its name, which replaces an equal file of an earlier attempt."""

    def __init__(self, folder: str, name: str, attempt: int):
        self.system, root = filesystem(folder)
        self.final, self.temporary = f"{root}/{name}", f"{root}/_temporary/{name}.{attempt}"
        self.system.create_dir(f"{root}/_temporary", recursive=True)
        self.stream = self.system.open_output_stream(self.temporary, compression=None)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def commit(self) -> None:
        self.stream.close()
        self.system.move(self.temporary, self.final)
