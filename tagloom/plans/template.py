"""The common run of a tag job (T0): catalogue, rules, source, tags, merge, save."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.lookup import Rules, short_rules
from tagloom.operators.merge import merge_profiles, merge_replacing, one_row_per_user, upsert
from tagloom.session import cut_lineage
from tagloom.sources.buckets import create_store, read_manifest, rewrite_store
from tagloom.sources.readers import level5_rules, read_profile, read_source, source_options
from tagloom.sources.versions import latest_version, save_version

Compute = Callable[[Rules, DataFrame], DataFrame]


@dataclass(frozen=True)
class SharedJob:
    """A job on a frame that several jobs make of the same source: `compute(rules, prepare(source))`.

    `prepare` runs once for all jobs with the same source and the same `prepare`.
    """

    prepare: Callable[[DataFrame], DataFrame]
    compute: Compute

    def __call__(self, rules: Rules, source: DataFrame) -> DataFrame:
        return self.compute(rules, self.prepare(source))


def new_tags(spark: SparkSession, catalogue: DataFrame, tag_id: int, compute: Compute) -> DataFrame:
    """Read the source the tag's rule names and compute tags: `compute(rules, source)`."""
    source = read_source(spark, source_options(catalogue, tag_id), as_strings=False)
    return compute(short_rules(level5_rules(catalogue, tag_id)), source)


def _prepared(spark: SparkSession, options: dict[int, dict], jobs: Mapping[int, Compute]) -> dict[int, DataFrame]:
    """The prepared frame of each shared job; sources are read once with all fields wanted."""
    groups: dict[tuple, list[int]] = {}
    for tag_id, job in jobs.items():
        if isinstance(job, SharedJob):
            place = frozenset((k, v) for k, v in options[tag_id].items() if k != "selectFields")
            groups.setdefault((place, job.prepare), []).append(tag_id)
    found = {}
    for (place, prepare), tag_ids in groups.items():
        lists = [options[t].get("selectFields") for t in tag_ids]
        rule = dict(place)
        if all(lists):
            rule["selectFields"] = ",".join(dict.fromkeys(f for fields in lists for f in fields.split(",")))
        frame = cut_lineage(prepare(read_source(spark, rule, as_strings=False)))
        found.update(dict.fromkeys(tag_ids, frame))
    return found


def run_tag_jobs(
    spark: SparkSession,
    catalogue: DataFrame,
    jobs: Mapping[int, Compute],
    profile_root: str,
    merge: bool = True,
    replace_siblings: bool = False,
    buckets: int | None = None,
) -> str:
    """Run the jobs of several tags and save one new profile version; returns its path.

    All tags are joined to the stored profile in a single merge. Users the jobs do not tag keep
    what is stored, so the saved profile is the full merge. Without `merge` the new tags
    replace a tagged user's stored ones (T1). With `replace_siblings` a new tag takes the place of the
    stored tags under the same parent, so that a user who changes band does not collect bands.

    With `buckets` a new profile is begun as a store of that many buckets. A run on such a store reads and rewrites the
    buckets of the users it tags, does not shuffle the stored side, and returns the path of the store.
    """
    options = {t: source_options(catalogue, t) for t in jobs}
    prepared = _prepared(spark, options, jobs)
    frames, siblings = [], []
    for tag_id, job in jobs.items():
        rules = short_rules(level5_rules(catalogue, tag_id))
        if tag_id in prepared:
            frames.append(job.compute(rules, prepared[tag_id]))
        else:
            frames.append(job(rules, read_source(spark, options[tag_id], as_strings=False)))
        siblings.append(rules)
    fresh = one_row_per_user(*frames)

    def combined(stored: DataFrame, new: DataFrame, key: str = "userId") -> DataFrame:
        if not merge:
            return upsert(stored, new, key)
        return merge_replacing(new, stored, siblings) if replace_siblings else merge_profiles(new, stored, "full")

    if read_manifest(spark, profile_root):
        rewrite_store(profile_root, fresh, combined)
        return profile_root
    current = latest_version(spark, profile_root)
    if current is None and buckets:
        create_store(fresh, profile_root, "userId", buckets)
        return profile_root
    if current is None:
        return save_version(fresh, profile_root)
    return save_version(combined(read_profile(spark, current), fresh), profile_root)


def run_tag_job(
    spark: SparkSession,
    catalogue: DataFrame,
    tag_id: int,
    compute: Compute,
    profile_root: str,
    merge: bool = True,
    buckets: int | None = None,
) -> str:
    """Run the job of one tag, see `run_tag_jobs`."""
    return run_tag_jobs(spark, catalogue, {tag_id: compute}, profile_root, merge, buckets=buckets)
