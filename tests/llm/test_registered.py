"""Registered queries beside their SQL, and the contract's columns, on the smallest tables."""

from __future__ import annotations

import zlib

import duckdb
import pytest

import check_oracles
import corpus_pipeline
from medoria.llm.oracles import ORACLES
from medoria.llm.queries import REGISTERED, tokenizer_files

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def connection(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, connection, sf_dir, name, monkeypatch):
    monkeypatch.setattr(check_oracles, "REGISTERED", REGISTERED)
    monkeypatch.setattr(check_oracles, "ORACLES", ORACLES)
    assert check_oracles.compare(spark, connection, name, sf_dir) is None


def test_all_thirteen_are_registered():
    assert [int(name[2:].split("_")[0]) for name in REGISTERED] == list(range(1, 14))


def labelled(connection, column):
    return dict(connection.execute(f"select doc_id, {column} from {'labels' if column == 'quality' else 'documents'}").fetchall())


def test_quality_of_held_out_rows(spark, connection, sf_dir):
    rows = REGISTERED["op3_quality"](spark, sf_dir).collect()
    known = labelled(connection, "quality")
    judged = [(r["predicted"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert len(rows) == 200 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert sum(a == b for a, b in judged) >= 0.9 * len(judged) > 5


def test_languages_of_held_out_rows(spark, connection, sf_dir):
    rows = REGISTERED["op9_language_id"](spark, sf_dir).collect()
    known = labelled(connection, "lang")
    judged = [(r["lang_pred"], known[r["doc_id"]]) for r in rows if r["held_out"]]
    assert sum(a == b for a, b in judged) >= 0.97 * len(judged) > 10


def check_pieces(rows, texts):
    """Every id of every document in one piece, in order; sequences without gaps and nearly full."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_files()["tokenizer"])
    of, at = {}, {}
    for r in rows:
        of.setdefault(r["doc_id"], []).append(r)
        at.setdefault(r["sequence_id"], []).append(r)
    assert of.keys() == texts.keys()
    for name, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        done = 0
        for r in sorted(of[name], key=lambda r: r["start"]):
            assert r["start"] == done and r["doc_tokens"] == len(ids)
            part = ids[done : done + r["length"]]
            assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)) == r["ids_crc32"]
            done += r["length"]
        assert done == len(ids)
    padding = total = 0
    for pieces in at.values():
        done = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == done
            done += r["length"]
        assert done <= 2048
        total += done
        padding += 0 if done & (done - 1) == 0 else 2048 - done
    assert padding < 0.02 * total + 1


def test_packing_keeps_every_id_once(spark, connection, sf_dir):
    rows = REGISTERED["op10_packing"](spark, sf_dir).collect()
    check_pieces(rows, dict(connection.execute("select doc_id, text from documents").fetchall()))


def test_pipeline(spark, connection, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    every = {r[0] for r in connection.execute("select doc_id from documents").fetchall()}
    dirty = {r["doc_id"] for r in REGISTERED["op6_decontamination"](spark, sf_dir).where("contaminated").collect()}
    left = {r["doc_id"] for r in rows}
    assert left <= every - dirty and len(left) > 0.8 * len(every - dirty)
    assert connection.execute("select count(distinct text) from documents").fetchone()[0] >= len(left)
