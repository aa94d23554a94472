"""Files of a shared folder, read and written by tasks: plain paths and ``file:`` locally, other stores through pyarrow.

The functions at the end run on the driver, a few times a job: they give names that must not be taken, and delete.
Other stores are reached through Spark's own file systems there.
"""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterator
from urllib.parse import unquote, urlparse


class Folder:
    def __init__(self, uri: str):
        self.made: set[str] = set()  # folders that need not be made again
        parsed = urlparse(uri)
        self.local = parsed.scheme in ("", "file")
        if self.local:
            self.root = unquote(parsed.path) if parsed.scheme else uri
        else:
            from pyarrow import fs

            self.fs, self.root = fs.FileSystem.from_uri(uri)
            self.prefix = uri[:uri.rfind(self.root)] if self.root and self.root in uri else ""

    def write(self, name: str):
        path = f"{self.root}/{name}"
        self.make_parent(name)
        return open(path, "wb") if self.local else self.fs.open_output_stream(path)

    def make_parent(self, name: str) -> None:
        path = os.path.dirname(f"{self.root}/{name}")
        if path in self.made:
            return
        if self.local:
            os.makedirs(path, exist_ok=True)
        else:
            self.fs.create_dir(path, recursive=True)
        self.made.add(path)

    def read(self, name: str):
        path = f"{self.root}/{name}"
        return open(path, "rb") if self.local else self.fs.open_input_stream(path)

    def read_range(self, name: str, start: int, length: int) -> bytes:
        """Up to ``length`` bytes from ``start`` on."""
        path = f"{self.root}/{name}"
        with open(path, "rb") if self.local else self.fs.open_input_file(path) as f:
            f.seek(start)
            return f.read(length)

    def exists(self, name: str) -> bool:
        path = f"{self.root}/{name}"
        return os.path.exists(path) if self.local else bool(self.fs.get_file_info(path).type)

    def rename(self, old: str, new: str) -> None:
        if self.local:
            os.replace(f"{self.root}/{old}", f"{self.root}/{new}")
        else:
            self.fs.move(f"{self.root}/{old}", f"{self.root}/{new}")

    def delete(self, names: list[str]) -> None:
        for name in names:
            (os.remove if self.local else self.fs.delete_file)(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        path = f"{self.root}/{folder}"
        if self.local:
            return [f"{folder}/{x}" for x in sorted(os.listdir(path))] if os.path.isdir(path) else []
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return [f"{folder}/{x.base_name}" for x in found]

    def entries(self) -> Iterator[tuple[str, bool, int]]:
        """Path, whether it is a folder, and size of what lies in the folder itself; nothing if it is absent.

        A local folder is read entry by entry, however many it holds. Links to folders are left out.
        """
        if self.local:
            try:
                found = os.scandir(self.root)
            except (FileNotFoundError, NotADirectoryError):
                return
            with found:
                for entry in found:
                    path = f"file:{os.path.abspath(self.root)}/{entry.name}"
                    if entry.is_dir(follow_symlinks=False):
                        yield path, True, 0
                    elif entry.is_file():
                        yield path, False, entry.stat().st_size
        else:
            from pyarrow import fs

            for info in self.fs.get_file_info(fs.FileSelector(self.root, allow_not_found=True)):
                yield self.prefix + info.path, info.type == fs.FileType.Directory, info.size or 0


def _java(spark, path: str):
    java = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = java.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _local(path: str) -> str | None:
    folder = Folder(path) if urlparse(path).scheme in ("", "file") else None
    return folder.root if folder else None


def path_exists(spark, path: str) -> bool:
    where, store = _java(spark, path)
    return store.exists(where)


def delete_tree(spark, path: str) -> None:
    """Delete a folder and all below it; nothing if it is absent."""
    if (own := _local(path)) is not None:
        shutil.rmtree(own, ignore_errors=True)
    else:
        where, store = _java(spark, path)
        store.delete(where, True)


def create_new(spark, path: str, content: bytes = b"") -> bool:
    """Create a file unless one of that name exists; of several that try at a time, one succeeds."""
    if (own := _local(path)) is not None:
        os.makedirs(os.path.dirname(own), exist_ok=True)
        try:
            with open(own, "xb") as f:
                f.write(content)
        except FileExistsError:
            return False
        return True
    where, store = _java(spark, path)
    if store.exists(where):
        return False
    try:
        stream = store.create(where, False)
    except Exception as exc:  # py4j wraps the store's own error
        if "AlreadyExists" in str(exc):
            return False
        raise
    stream.write(bytearray(content))
    stream.close()
    return True


def rename_new(spark, old: str, new: str) -> bool:
    """Give a written file or folder its final name unless the name is taken (one step where the store renames in one)."""
    if (target := _local(new)) is not None:
        source = _local(old)
        os.makedirs(os.path.dirname(target), exist_ok=True)
        try:
            if os.path.isdir(source):
                os.rename(source, target)  # refuses a folder that holds anything
            else:
                os.link(source, target)
                os.remove(source)
        except OSError:
            if os.path.exists(target):
                return False
            raise
        return True
    where, store = _java(spark, new)
    if store.exists(where):
        return False
    store.mkdirs(where.getParent())
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(_java(spark, old)[0], where, options)
    except Exception as exc:
        if "AlreadyExists" in str(exc):
            return False
        raise
    return True
