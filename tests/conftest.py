import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]")
         .appName("corpusmill-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        # tests only: the shared checkpoint folder is unset on a local session
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusmill-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tree(tmp_path):
    """A real folder tree with the awkward names the listing must keep."""
    files = {
        "root.JPG": b"x",
        "A/a1.png": b"xx",
        "A/_u.jpg": b"x",
        "A/.h.jpg": b"x",
        "A/b/deep.jpeg": b"xxx",
        "A/b/c/deeper.gif": b"x",
        "A/notes.txt": b"t",
        ".hid/1.jpg": b"x",
        "_u/1.jpg": b"x",
        "Z/empty.jpg": b"",
        "sp ace/#1 %.png": b"x",
        "Ünï/ça.svg": b"x",
        "P/paper.pdf": b"%PDF",
        "P/Paper2.PDF": b"%PDF",
        "P/Converted/paper.md": b"# x",
        "P/Converted/old.pdf": b"%PDF",
    }
    for rel, data in files.items():
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    (tmp_path / "emptydir").mkdir()
    return tmp_path, sorted(files)
