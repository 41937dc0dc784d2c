"""Publishing: readers and builders that run at the same time."""

import threading

from pacelake.sources import fs
from pacelake.sources.sinks import current_version, prune_versions, publish_version


def test_reader_between_publishes_always_finds_a_version(spark, tmp_dir):
    publish_version(spark, tmp_dir, "v_0")
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(current_version(spark, tmp_dir))

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 40):
        publish_version(spark, tmp_dir, f"v_{i}", f"stamp {i}")
    stop.set()
    reader.join()
    assert seen and None not in seen
    order = [int(v.split("_")[1]) for v in seen]
    assert order == sorted(order) and current_version(spark, tmp_dir) == "v_39"
    assert fs.list_files(spark, tmp_dir) == ["_CURRENT"]  # no temporary file left


def test_two_builders(spark, tmp_dir):
    def build(name):
        for i in range(12):
            publish_version(spark, tmp_dir, f"v_{name}{i}")

    builders = [threading.Thread(target=build, args=(n,)) for n in "ab"]
    for b in builders:
        b.start()
    for b in builders:
        b.join()
    assert current_version(spark, tmp_dir) in ("v_a11", "v_b11")


def test_pruning_follows_the_pointer(spark, tmp_dir):
    versions = f"{tmp_dir}/mv"
    for v in ("v_1", "v_2", "v_3", "v_4", "v_5"):
        fs.mkdirs(spark, f"{versions}/{v}")
    assert prune_versions(spark, tmp_dir, versions) == []  # nothing is published
    publish_version(spark, tmp_dir, "v_4")
    assert prune_versions(spark, tmp_dir, versions) == ["v_1", "v_2"]
    assert fs.list_dirs(spark, versions) == ["v_3", "v_4", "v_5"]  # v_5: another builder's, not published yet
    assert prune_versions(spark, tmp_dir, versions, keep=1) == ["v_3"]


def test_fingerprint_sees_changes(spark, tmp_dir):
    fs.mkdirs(spark, f"{tmp_dir}/t/sub")
    first = fs.fingerprint(spark, f"{tmp_dir}/t", f"{tmp_dir}/none")
    fs.write_small_text(spark, f"{tmp_dir}/t/sub/x", "1")
    second = fs.fingerprint(spark, f"{tmp_dir}/t", f"{tmp_dir}/none")
    assert first != second and second == fs.fingerprint(spark, f"{tmp_dir}/t", f"{tmp_dir}/none")
    assert second[0][1] == -1 or second[1][1] == -1  # a missing path
