"""What the driver holds of the labelled sample, and of the memory of the fit."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from waferline.llm import common

REPO = Path(__file__).parents[2]
#: Trains on 1,500 texts of 6 KB without Spark; prints the MB of the process before and after.
TRAIN = """
import random, re
from pathlib import Path
from waferline.llm import toxicity

def held():
    return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

def sample(*_):
    draw = random.Random(5)
    words = ["%x" % draw.getrandbits(40) for _ in range(30000)]
    texts = [" ".join(draw.choices(words, k=600)) for _ in range(1500)]
    return [(t + " idiot" * (i % 2), i % 2) for i, t in enumerate(texts)], {0: 750, 1: 750}

toxicity.labelled_sample = sample
toxicity.fit([("a", 0), ("idiot", 1)], {0: 1, 1: 1})  # what the libraries take at their first use
before = held()
toxicity.train(None, None, None)
print(before, held())
"""


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_training_leaves_no_memory_behind():
    out = subprocess.run([sys.executable, "-c", TRAIN], cwd=REPO, capture_output=True, text=True, check=True, timeout=300).stdout
    before, after = map(float, out.split())
    assert after - before < 25


def test_sampled_texts_come_part_by_part(spark, monkeypatch):
    rows = [(i, None if i % 50 == 7 else f"text {i}") for i in range(200)] + [(3, "text 3"), (3, "again"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)] + [(4, 1), (900, 1)], "doc_id bigint, toxic int")
    collected, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: collected.append(self.columns) or collect(self))
    sample, sizes = common.labelled_sample(docs, labels, "toxic", F.lit(True), 1000)
    assert collected and not any("text" in columns for columns in collected)
    toxic = {i for i in range(150) if i % 2 or i == 4}
    expected = sorted((i, t or "", int(i in toxic)) for i, t in rows if i is not None and i < 150)
    assert sample == [(t, y) for _, t, y in expected] and sizes == {0: 74, 1: 77}


def test_blocks_of_a_list_are_those_of_its_texts():
    texts = [f"ä{i}" * (i % 9) for i in range(1300)]
    seen = 0
    for low, high, data, bounds in common.list_blocks(texts, 1000):
        assert low == seen and [bytes(data[a:b]).decode() for a, b in zip(bounds[:-1], bounds[1:])] == texts[low:high]
        seen = high
    assert seen == len(texts) and not list(common.list_blocks([]))
