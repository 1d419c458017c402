"""Identifiers and techniques mined from text, related rows, and table choice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import identifiers as I
from tidemark.shared import materialise, ship

#: Repository identifiers by pass; a later pass is only tried on texts in which the earlier found nothing.
PASSES = (
    (
        ("bioproject_accession", r"PRJ(?:NA|EB|DB)\d+"),
        ("sra_study_accession", r"(?:SRP|ERP|DRP)\d+"),
        ("assembly_accession", r"GC[AF]_\d{9}\.\d+"),
        ("cncb_project_accession", r"PRJCA\d+"),
        ("cncb_biosample_accession", r"SAMC\d+"),
        ("cncb_study_accession", r"CRA\d+"),
        ("cncb_experiment_accession", r"CRX\d+"),
        ("cncb_run_accession", r"CRR\d+"),
        ("dataset_doi", r"10\.1594/PANGAEA\.\d+"),
        ("dataset_doi", r"10\.(?:1575|26008)/1912/(?:bco[-.]dmo|bcodmo)[^\s<>()\[\]{}\"']*"),
    ),
    (
        ("dataset_doi", r"10\.5281/zenodo\.\d+"),
        ("dataset_doi", r"10\.5061/dryad\.[a-z0-9]+"),
        ("dataset_doi", r"10\.6084/m9\.figshare\.\d+(?:\.v\d+)?"),
        ("dataset_doi", r"10\.17605/OSF\.IO/[A-Z0-9]+"),
    ),
    (("repository_url", r"https?://(?:www\.)?(?:zenodo\.org|datadryad\.org|figshare\.com|osf\.io)/[^\s,;)\]]+"),),
)


def staged(docs: DataFrame, key: str, text: str, passes: tuple = PASSES) -> DataFrame:
    """(key, identifier_type, value, pass): identifiers of the first pass that finds any in a text; key names a row. One scan."""

    def of(kind: str, p: str, n: int) -> Column:
        hits = F.regexp_extract_all(F.col(text), F.lit(rf"(?i)\b({p})"), F.lit(1))
        return F.transform(hits, lambda v: F.struct(F.lit(kind).alias("identifier_type"), F.regexp_replace(v, r"[.,;:]+$", "").alias("value"), F.lit(n).alias("pass")))

    found = [F.concat(*(of(kind, p, n) for kind, p in patterns)) for n, patterns in enumerate(passes, 1)]
    first = F.coalesce(*(F.when(F.size(f) > 0, f) for f in found))
    return docs.select(key, F.explode(F.array_distinct(first)).alias("f")).select(key, "f.*")


def only_related(edges: DataFrame, kind: str) -> DataFrame:
    """The only target of each source by edges of a kind (from_id, to_id, kind); several are an error row, not a guess."""
    g = edges.where(F.col("kind") == kind).groupBy("from_id").agg(F.count_distinct("to_id").alias("n"), F.min("to_id").alias("to_id"))
    return g.select("from_id", F.when(F.col("n") == 1, F.col("to_id")).alias("to_id"), (F.col("n") > 1).alias("ambiguous"))


def union_sizes(members: pa.Table, lists: pa.Table) -> pa.Table:
    """(study_id, n): per list (study_id, entities) how many different members (entity_id, others) its entities have together.

    Lists are walked in the order of their entities, large ones first, so that what two lists begin with is united once.
    """
    others = pc.list_flatten(members["others"]).combine_chunks().dictionary_encode().indices.to_numpy()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(members["others"]).to_numpy())])
    by_size = np.argsort(-np.diff(ends), kind="stable")
    sets = [others[ends[k] : ends[k + 1]] for k in by_size]
    place = pa.array(np.argsort(by_size))
    known = pc.take(place, pc.index_in(pc.list_flatten(lists["entities"]), value_set=members["entity_id"].combine_chunks()))
    cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists["entities"]).to_numpy())])
    flat = pc.fill_null(known, -1).to_numpy()
    paths = [sorted(x for x in flat[cuts[i] : cuts[i + 1]].tolist() if x >= 0) for i in range(len(cuts) - 1)]
    seen, path, added, sizes = np.zeros(int(others.max()) + 1 if len(others) else 0, bool), [], [], np.zeros(len(paths), np.int64)
    order = sorted(range(len(paths)), key=paths.__getitem__)
    total = 0
    for at, i in enumerate(order):
        new, following = paths[i], paths[order[at + 1]] if at + 1 < len(order) else []
        same = 0
        while same < len(path) and same < len(new) and path[same] == new[same]:
            same += 1
        while len(path) > same:
            gone = added.pop()
            seen[gone] = False
            total -= len(gone)
            path.pop()
        for k in range(same, len(new)):
            s = sets[new[k]]
            if k == len(new) - 1 and following[: k + 1] != new:  # no other list goes on from here
                sizes[i] = total + len(s) - np.count_nonzero(seen[s])
                break
            fresh = s[~seen[s]]
            seen[fresh] = True
            total += len(fresh)
            path.append(new[k])
            added.append(fresh)
        else:
            sizes[i] = total
    return pa.table({"study_id": lists["study_id"], "n": pa.array(sizes)})


def siblings(links: DataFrame, members: int = 8_000_000, visits: int = 1 << 31, most: int = 16) -> DataFrame:
    """(study_id, n): how many other studies share an entity with a study; those with none don't appear.

    No pair of studies is written. Links are dealt to cells of a grid: a block of the studies that are counted, of about
    `members` links, and a part of those that they are counted for. A cell unites its entities' sets in memory and gives a
    number a study; a study's numbers add up over the blocks. What is shuffled is the links times the sides of the grid; parts
    follow the members to be visited, up to `most`. Every study in the links meets itself once, in one block.
    """
    spark = links.sparkSession
    ship(spark)
    rows = materialise(links.where("study_id IS NOT NULL AND entity_id IS NOT NULL").select("study_id", "entity_id").distinct(), "links")
    count = rows.groupBy("entity_id").count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.sum(F.col("count").cast("double") * F.col("count")), F.lit(0.0))).first()
    blocks, parts = -(-count[0] // members) or 1, max(1, min(most, max(-(-count[0] // 1_000_000), int(count[1] // visits) + 1)))
    hashed = lambda n: F.pmod(F.xxhash64("study_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sets = rows.groupBy("entity_id", hashed(blocks).alias("block")).agg(F.collect_list("study_id").alias("others")).select("*", every(parts).alias("part"))
    lists = rows.groupBy("study_id", hashed(parts).alias("part")).agg(F.collect_list("entity_id").alias("entities")).select("*", every(blocks).alias("block"))
    cell = lambda t: t.groupBy((F.col("block") * parts + F.col("part")).alias("cell"))
    kind = rows.schema["study_id"].dataType.simpleString()
    per = cell(sets).cogroup(cell(lists)).applyInArrow(lambda m, s: union_sizes(m, s), f"study_id {kind}, n long")
    return per.groupBy("study_id").agg((F.sum("n") - 1).alias("n")).where("n > 0")


def chosen_table(terms: DataFrame, classes: DataFrame, preferred: list[str], overrides: dict[str, str], default: str = "projectMetadata") -> DataFrame:
    """Where a field goes: its override, else the first preferred class that has it, else the default."""
    rank = F.coalesce(*(F.when(F.col("class") == c, i) for i, c in enumerate(preferred)))
    best = classes.where(rank.isNotNull()).groupBy("field").agg(F.min_by("class", rank).alias("class"))
    over = F.coalesce(*(F.when(F.col("field") == k, F.lit(v)) for k, v in overrides.items()), F.lit(None).cast("string"))
    return terms.join(best, "field", "left").select("field", F.coalesce(over, "class", F.lit(default)).alias("target_table"))


def resolved_flags(values: DataFrame, by: list[str]) -> DataFrame:
    """Of 1 and 0 for a field, 1 stays."""
    return values.groupBy(*by).agg(F.max("value").alias("value"))


def merged_maps(first: Column, second: Column, left_out: list[str]) -> Column:
    """Two maps of piped values as one, the first's values before the second's; fields of `left_out` only from the first."""
    kept = F.map_filter(second, lambda k, v: ~k.isin(*left_out))
    return F.map_zip_with(first, kept, lambda k, a, b: F.when(F.lower(F.coalesce(a, F.lit(""))) == F.lower(F.coalesce(b, F.lit(""))), a).otherwise(F.concat_ws(" | ", a, b)))


def run_windows(runs: DataFrame, key: str) -> DataFrame:
    """Pages fetched and the last cursor of each crawl, to resume from."""
    return runs.groupBy(key).agg(F.count("*").alias("pages"), F.max_by("cursor", "page").alias("cursor"))


def reset_failed(tasks: DataFrame, now: Column, days: int) -> DataFrame:
    """Tasks left for review or failed, untouched for `days`, start again with no attempts used."""
    old = F.col("status").isin("failed", "manual_review_required") & (F.date_diff(now, "updated_at") >= days)
    return tasks.withColumns({"attempt_count": F.when(old, 0).otherwise(F.col("attempt_count")), "status": F.when(old, "pending").otherwise(F.col("status"))})


def cited_accessions(docs: DataFrame, key: str, text: str) -> DataFrame:
    found = I.accessions(docs, key, text)
    return found.groupBy(key, "archive").agg(F.count("*").alias("n"), F.min("accession").alias("first"))
