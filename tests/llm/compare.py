"""Compare registered queries with the plain versions: python -m tests.llm.compare SF_DIR op ..."""

from __future__ import annotations

import sys
import time

from tablewright.llm import queries
from tests.llm import brute


def read(sf_dir, table):
    import duckdb

    return duckdb.sql(f"select * from read_parquet('{sf_dir}/{table}.parquet')").fetchall()


def expect(op, docs, sf_dir):
    texts = {d[0]: d[1] for d in docs}
    if op == "op1":
        from tablewright.llm.licenses import rules

        for i, t in texts.items():
            found = brute.license_found(t, rules())
            base = brute.license_base(t)
            labels = {rules()[s[2]].label for s in found} | set(filter(None, base[4].split(",")))
            score = max([rules()[s[2]].confidence for s in found] + [0.5 if base[1] else 0.0])
            yield (i, *base, ",".join(sorted(labels)), score)
    elif op == "op7":
        from tablewright.llm.secrets import BASE, RULES

        for i, t in texts.items():
            spans = brute.secret_spans(t, RULES)
            name = lambda ss: ",".join(f"{RULES[k].kind}:{a}:{b}" for a, k, b in ss)
            n = [sum(k == x for _, k, _ in spans) for x in range(len(BASE))]
            yield (i, *n, brute.sha(name([s for s in spans if s[1] < len(BASE)])), name(spans))
    elif op == "op10":
        windows = brute.items_windows(read(sf_dir, "benchmark"))
        for i, t in texts.items():
            n, hit, items = brute.contamination(t, windows)
            yield i, n, hit, len(items), brute.sha(",".join(sorted(items))), hit > 0
    elif op == "op3":
        for i, t in texts.items():
            n, chars, symbols, lines, rep = brute.quality(t)
            yield i, n, chars, symbols, lines, rep, n < 50 or 100 * rep > 50 * n
    elif op == "op4":
        yield from brute.repeats(texts.items())
    elif op == "op5":
        yield from ((i, n, c) for i, (n, c) in brute.components(texts.items()).items())
    elif op == "op11":
        yield from brute.manifest(docs)
    elif op == "op12":
        yield from brute.collocations(docs)
    elif op == "op13":
        ids = brute.token_ids([d[1] for d in docs])
        for d, own in zip(docs, ids):
            for at in range(0, len(own), 2048):
                part = own[at : at + 2048]
                yield d[0], at, len(part), brute.ids_crc(part), len(own)


COLUMNS = {
    "op1": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op3": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed",
    "op4": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5": "doc_id n_shingles component_id",
    "op7": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op11": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12": "lang rank phrase a l r n score",
    "op13": "doc_id start length ids_crc32 doc_tokens",
    "op10": "doc_id n_words n_hit n_items items_sha256 contaminated",
}


def differences(spark, sf_dir, op):
    docs = read(sf_dir, "documents")
    name = next(x for x in queries.queries() if x.startswith(op + "_"))
    got = {tuple(r) for r in queries.queries()[name](spark, sf_dir).select(*COLUMNS[op].split()).collect()}
    want = set(expect(op, docs, sf_dir))
    return sorted(got - want, key=str), sorted(want - got, key=str), len(got)


def main():
    from tablewright.session import local_session

    spark = local_session(8)
    for op in sys.argv[2:]:
        start = time.time()
        more, less, n = differences(spark, sys.argv[1], op)
        print(op, n, "rows", len(more), len(less), "differ", more[:2], less[:2], f"{time.time() - start:.0f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
