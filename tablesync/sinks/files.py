"""Shared-storage helpers for the driver: small files, directory names, staged frames."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Setting that names the commit protocol of a store that is not known.
COMMIT_SETTING = "spark.tablesync.commitProtocol"
# File systems whose rename is atomic and can refuse to overwrite, those whose creation without
# overwriting is conditional on the store itself, and the option by which others offer that.
ATOMIC_RENAME = {"file", "hdfs", "viewfs", "abfs", "abfss"}
CONDITIONAL_CREATE = {"gs"}
CONDITIONAL_OPTION = "fs.option.create.conditional.overwrite"
#: Spark's setting by which an action removes its shuffle files when it ends.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class CommitProtocolError(RuntimeError):
    """The storage has no way known to be safe to make a commit."""


_RUN_DIRS: set[str] = set()
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor can reach.

    It is the session's `spark.checkpoint.dir`. Only a local session may do without it; it
    then gets a folder in its warehouse directory, which is removed when the session's JVM ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    own = SharedFiles(spark, f"{warehouse}/_staged-{spark.sparkContext.applicationId}")
    own.delete_root_on_exit()
    return own.root


def new_path(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing else uses.

    It lies in the application's own folder, which goes when the application ends.
    """
    own = f"{shared_dir(spark)}/run-{spark.sparkContext.applicationId}"
    if own not in _RUN_DIRS:
        SharedFiles(spark, own).delete_root_on_exit()
        _RUN_DIRS.add(own)
    return f"{own}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str = "staged", compression: str | None = None) -> DataFrame:
    """Write a frame once to the shared folder and return the written copy.

    The copy has no lineage to its source, so it is neither read again nor able to change
    between the steps of a run, and it survives the loss of executors. It is removed at the
    end of the `staging_scope` it was made in, else at the end of the application. `compression` is
    that of its files, the session's if it is not given.
    """
    spark = df.sparkSession
    path = new_path(spark, purpose)
    scope = _STAGED.get()
    if scope is not None:
        scope.append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the staged frames of a block when it ends, however it ends."""
    paths: list[str] = []
    token = _STAGED.set(paths)
    try:
        yield
    finally:
        _STAGED.reset(token)
        for path in paths:
            SharedFiles(spark, path).delete_root()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Let each action of a block remove its shuffle files when it ends.

    Otherwise they stay on the executors' disks until the driver happens to collect its garbage, so
    those of all steps of a merge may lie there together. A frame that is used again is computed again.
    """
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)


class SharedFiles:
    """Hadoop file system calls the driver needs for commit files."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        path = self._path(root)
        self._fs = path.getFileSystem(self._conf)
        self.root = str(self._fs.makeQualified(path).toString()).rstrip("/")
        self._scheme = self._fs.getUri().getScheme()

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def names(self, directory: str) -> list[str]:
        """Names in a directory; empty if it does not exist."""
        path = self._path(directory)
        if not self._fs.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(path)]

    def directories(self, pattern: str) -> list[str]:
        """Qualified paths of the directories that match a glob."""
        found = self._fs.globStatus(self._path(pattern)) or []
        return [str(s.getPath().toString()) for s in found if s.isDirectory()]

    def delete_root(self) -> None:
        """Remove the directory these calls were made for, with all it holds."""
        self._fs.delete(self._path(self.root), True)

    def delete_root_on_exit(self) -> None:
        """Make the directory and have it removed when the session's JVM ends."""
        self._fs.mkdirs(self._path(self.root))
        self._fs.deleteOnExit(self._path(self.root))

    def size(self, paths: Sequence[str]) -> int:
        """Bytes under the paths."""
        return sum(
            int(self._fs.getContentSummary(self._path(path)).getLength()) for path in paths
        )

    def read_text(self, file: str) -> str:
        stream = self._fs.open(self._path(file))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def commit_protocol(self) -> str:
        """How a file is made that no other writer may replace: `rename` or `create`.

        `create` asks the store to make the object only if there is none of its name, where the file
        system says that it can, or is known to. `rename` is for file systems whose rename is atomic
        and refuses to overwrite. The setting `spark.tablesync.commitProtocol` names one for others;
        without it they raise, rather than let a second writer win unnoticed.
        """
        named = self._spark.conf.get(COMMIT_SETTING, None)
        if named is not None:
            if named not in ("rename", "create"):
                raise ValueError(f"{COMMIT_SETTING} is rename or create, not {named!r}")
            return named
        scheme = str(self._scheme)
        if self._conditional() or scheme in CONDITIONAL_CREATE:
            return "create"
        if scheme in ATOMIC_RENAME:
            return "rename"
        raise CommitProtocolError(
            f"no commit protocol is known to be safe on {scheme}: name one in {COMMIT_SETTING}"
        )

    def _conditional(self) -> bool:
        """Whether the file system offers conditional creation as an option of its builder."""
        return bool(self._fs.hasPathCapability(self._path(self.root), CONDITIONAL_OPTION))

    def create(self, file: str, text: str) -> bool:
        """Create a file with its whole content, or return False if it exists already.

        No reader sees half a file: it is written under another name and renamed, or appears with
        its last byte, as objects of a store do.
        """
        final = self._path(file)
        if self.commit_protocol() == "create":
            return self._create_if_absent(final, text)
        return self._rename_if_absent(final, text)

    def _create_if_absent(self, final, text: str) -> bool:
        try:
            if self._conditional():
                builder = self._fs.createFile(final).overwrite(False)
                stream = builder.must(CONDITIONAL_OPTION, True).recursive().build()
            else:
                stream = self._fs.create(final, False)
            try:
                stream.write(bytearray(text.encode()))
            finally:
                stream.close()  # a store refuses here at the latest
        except Exception as error:
            if self._taken(error) or (self._fs.exists(final) and self.read_text(str(final)) != text):
                return False
            raise error
        return True

    @staticmethod
    def _taken(error: Exception) -> bool:
        """Whether an error of the file system says that the file exists, or a precondition failed."""
        cause = getattr(error, "java_exception", None)
        while cause is not None:
            if cause.getClass().getSimpleName() in ("FileAlreadyExistsException", "RemoteFileChangedException"):
                return True
            cause = cause.getCause()
        return False

    def _rename_if_absent(self, final, text: str) -> bool:
        draft = self._path(f"{final.getParent()}/.{uuid.uuid4().hex}.tmp")
        self._fs.mkdirs(final.getParent())
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        no_overwrite = self._gateway.new_array(rename, 1)
        no_overwrite[0] = rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            final.toUri() if final.toUri().getScheme() else self._fs.getUri(), self._conf
        )
        try:
            context.rename(draft, final, no_overwrite)
        except Exception as error:
            self._fs.delete(draft, False)
            if self._fs.exists(final):
                return False
            raise error
        return True
