"""The line rules, on lines as they stand in a file (a backslash and a letter for a line end)."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cotrend import extract_imports, imported_names, scan_lines

from .conftest import rows

# Lines and the names they must give.
GOLDEN = [
    (r'    "import numpy as np\n",', ["numpy"]),
    (r'    "import seaborn\n",', ["seaborn"]),
    (r'    "import seaborn"', ["seabor"]),
    (r'    "from sklearn.cluster import KMeans\n",', ["sklearn"]),
    (r'    "import matplotlib.pyplot as plt\n",', ["matplotlib"]),
    (r'    "import os, sys\n",', ["os", "sys"]),
    (r'    "import os,sys\n",', ["os,sys"]),
    (r'    "    import keras\n",', []),
    (r'    "# import keras\n",', []),
    (r'    "import keras # deep\n",', ["keras", ""]),
    (r'    "import numpy as np, pandas as pd\n",', ["numpy"]),
    (r'    "from . import x\n",', [""]),
    (r"import theano", ["theano"]),
    (r'    "import tensorflow;\n",', ["tensorflow;"]),
    (r'  "source": "import numpy\nimport pandas"', []),
    (r'    "nimport gensim\n",', ["gensim"]),
    (r'    "from nltk import n\n",', ["nltk"]),
    (r'    "import numpy.random,scipy\n",', ["numpy"]),
    (r'    "import pandas as pd; import scipy\n",', ["pandas"]),
    (r'    "from numpy import *"', ["numpy"]),
    ("", []),
    (r'    "import\n",', []),
    (r'    "from a.b\n",', []),
    (r'    "import numpy\r\n",', [r"numpy\r"]),
    (r'    "import  numpy\n",', ["", "numpy"]),
    (r'    "import sklearn",', ["sklear"]),
    (r'    "from  x import y\n",', []),
    # more of the same rules
    ("\t\"import scipy\\n\",\r", ["scipy"]),
    (r'"import a.b.c, d.e\n",', ["a", "d"]),
    (r'"from a.b import c, d\n",', ["a"]),
    (r'"from a,b import c\n",', ["a,b"]),
    (r'"from x importy\n",', []),
    (r'"import numpy as np # note as such\n",', ["numpy"]),
    (r'"important, import x\n",', []),
    (r',"import numpy\n",', ["numpy"]),
    (r'"import x as ",', ["x"]),
    ("import x as ", ["x", "as"]),
]


@pytest.mark.parametrize("at", range(0, len(GOLDEN), 12))
def test_golden_lines(spark, at):
    part = GOLDEN[at : at + 12]
    lines = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(part)], "i int, line string")
    named = lines.select("i", F.coalesce(imported_names(F.col("line")), F.array().cast("array<string>")).alias("n"))
    got = {row.i: row.n for row in named.collect()}
    assert [got[i] for i in range(len(part))] == [names for _, names in part]


def test_extract_is_the_line_rule_per_file(spark):
    lines = spark.createDataFrame([(str(i % 5), line) for i, (line, _) in enumerate(GOLDEN)], "path string, line string")
    expected = sorted({(str(i % 5), name) for i, (_, names) in enumerate(GOLDEN) for name in names})
    assert rows(extract_imports(lines)) == expected
    every = sorted((str(i % 5), name) for i, (_, names) in enumerate(GOLDEN) for name in names)
    assert rows(extract_imports(lines, distinct=False)) == every


def test_long_line_is_read_whole(spark):
    text = '"import numpy' + " " * 3_000_000 + ', scipy\\n",'
    lines = spark.createDataFrame([("p", text)], "path string, line string")
    assert rows(extract_imports(lines)) == [("p", ""), ("p", "numpy"), ("p", "scipy")]


def names_by_hand(line):
    for ends in (r"\s", ",", '"', "n", r"\\"):
        line = re.sub(rf"\A[{ends}]+|[{ends}]+\Z", "", line, flags=re.ASCII)
    head, *rest = re.split("#| as ", line, maxsplit=1)[0].split(" ")
    if head == "import":
        return [re.match(r"[^.]*", word.strip(", ")).group() for word in rest]
    if head == "from" and rest[1:2] == ["import"]:
        return [re.match(r"[^.]*", rest[0]).group()]
    return []


@pytest.mark.parametrize("seed", [1, 2])
def test_random_lines(spark, seed):
    choose = random.Random(seed)
    pieces = ["import", "from", " as ", " ", " ", ",", ".", "#", '"', "n", "\\", "\t", "\r", "numpy", "é", "scipy.x", ", "]
    lines = ["".join(choose.choices(pieces, k=choose.randint(0, 9))) for _ in range(1500)]
    lines += ["import " + line for line in lines[:500]] + ["from x import" + line for line in lines[:500]]
    lines = ['  "' + line + '\\n",' if choose.random() < 0.5 else line for line in lines]
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    expected = sorted((i, name) for i, line in enumerate(lines) for name in names_by_hand(line))
    got = extract_imports(frame, by="i", distinct=False)
    assert rows(got) == expected and len(expected) > 500


def test_one_file_read_by_many_tasks(spark, tmp_path):
    body = "".join(f'    "import {name}\\n",\n' + '    "x = 1\\n",\n' * 2000 for name in ("numpy", "scipy", "numpy"))
    (tmp_path / "nb_1.ipynb").write_text(body)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        lines = scan_lines(spark, [str(tmp_path)])
        assert lines.rdd.getNumPartitions() > 5 and lines.count() == body.count("\n")
        got = rows(extract_imports(lines))
        assert [item for _, item in got] == ["numpy", "scipy"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
