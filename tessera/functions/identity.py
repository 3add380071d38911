"""Identity functions over columns: audio paths, sources, recording groups, record ids, stable choices.

Sources are named by rules that the user gives, in order; nothing here knows a data set.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import strip, text

AUDIO_FIELDS = ("audio", "wav_path", "audio_path")


@dataclass(frozen=True)
class SourceRule:
    """A source and what tells of it: parts of a declared name, parts of a path, the field that holds the path."""

    name: str
    declared: tuple[str, ...] = ()
    path: tuple[str, ...] = ()
    field: str | None = None


def field(df: DataFrame, name: str) -> Column:
    """The column as a string, null where the table has none of that name."""
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def present(c: Column) -> Column:
    """The value without white space around it, null if nothing is left."""
    return F.nullif(strip(text(c)), F.lit(""))


def first_present(*columns: Column) -> Column:
    return F.coalesce(*(present(c) for c in columns))


def audio_value(df: DataFrame) -> tuple[Column, Column]:
    """The first audio path that isn't blank, and the name of its field."""
    values = [(f, present(field(df, f))) for f in AUDIO_FIELDS]
    named = F.coalesce(*(F.when(v.isNotNull(), F.lit(f)) for f, v in values))
    return F.coalesce(*(v for _, v in values)), named


def slashed(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit("/"))


def is_absolute(c: Column) -> Column:
    return c.startswith("/") | c.rlike("^[A-Za-z]:[\\\\/]")


def path_parts(c: Column) -> Column:
    return F.filter(F.split(slashed(F.coalesce(c, F.lit(""))), "/"), lambda p: p != "")


def collapse(c: Column) -> Column:
    """A path with slashes, without empty and dot parts; a double dot takes the part before it, if there is one to take."""
    c = slashed(c)
    rooted = c.startswith("/")
    parts = F.filter(F.split(c, "/"), lambda p: (p != "") & (p != "."))

    def step(done: Column, p: Column) -> Column:
        can = (F.size(done) > 0) & (F.element_at(F.concat(F.array(F.lit("")), done), -1) != "..")
        back = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(p != "..", F.concat(done, F.array(p))).when(can, back).when(rooted, done).otherwise(F.concat(done, F.array(p)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    joined = F.array_join(kept, "/")
    two = c.startswith("//") & ~c.startswith("///")
    head = F.when(two, "//").when(rooted, "/").otherwise("")
    return F.when((joined == "") & ~rooted, ".").otherwise(F.concat(head, joined))


def resolve_audio(value: Column, root: str | None = None) -> Column:
    """An absolute path collapsed; a relative one put under the root, if there is one."""
    v = slashed(value)
    under = collapse(F.concat(F.lit((root or "").replace("\\", "/").rstrip("/") + "/"), v)) if root else v
    return F.when(is_absolute(v), collapse(v)).otherwise(under)


def infer_source(df: DataFrame, rules: list[SourceRule]) -> Column:
    """The first rule that a declared field names, field by field; else the first whose path or field fits; else unknown."""
    whens = []
    for f in ("source", "dataset_source", "control_source"):
        low = F.lower(strip(text(field(df, f))))
        for r in rules:
            if r.declared:
                whens.append((_any(low.contains(p) for p in r.declared), r.name))
    value, named = audio_value(df)
    path = F.lower(slashed(F.coalesce(value, F.lit(""))))
    padded = F.concat(F.lit("/"), F.btrim(path, F.lit("/")), F.lit("/"))
    for r in rules:
        fits = [(padded if p.startswith("/") else path).contains(p) for p in r.path] + ([named == r.field] if r.field else [])
        if fits:
            whens.append((_any(fits), r.name))
    out = F.lit("unknown")
    for test, name in reversed(whens):
        out = F.when(test, name).otherwise(out)
    return out


def _any(tests) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | F.coalesce(t, F.lit(False))
    return out


def recording_group(df: DataFrame, source: Column, goal: str, whole_prefix: tuple[str, ...] = (), itemized: tuple[str, ...] = ()) -> Column:
    """A conservative group of recordings: the path before the goal folder (all of it for some sources, else two parts), a speaker, an item stem with gender (for some sources), or the path's first parts."""
    value, _ = audio_value(df)
    stable = F.coalesce(present(field(df, "audio_path")), value)
    parts = path_parts(F.when(source.isin(*whole_prefix), stable).otherwise(value)) if whole_prefix else path_parts(value)
    at = F.array_position(parts, F.lit(goal))
    whole = F.when(at > 1, F.array_join(F.slice(parts, F.lit(1), (at - 1).cast("int")), "/"))
    first = F.greatest(at - 2, F.lit(1))
    near = F.when(at > 1, F.array_join(F.slice(parts, first.cast("int"), (at - first).cast("int")), "/"))
    speaker = present(field(df, "speaker_id"))
    item, gender = present(field(df, "item_name")), F.coalesce(F.lower(present(field(df, "gender"))), F.lit("unknown"))
    stem = F.regexp_replace(item, "[_-]?\\d+$", "")
    is_whole = source.isin(*whole_prefix) if whole_prefix else F.lit(False)
    is_item = source.isin(*itemized) if itemized else F.lit(False)
    return (
        F.when(is_whole & whole.isNotNull(), F.concat(source, F.lit(":recording:"), whole))
        .when(speaker.isNotNull(), F.concat(source, F.lit(":speaker:"), speaker))
        .when(near.isNotNull(), F.concat(source, F.lit(":recording:"), near))
        .when(is_item & item.isNotNull(), F.concat(source, F.lit(":item:"), stem, F.lit(":gender:"), gender))
        .when(is_item & (F.size(parts) > 0), F.concat(source, F.lit(":unresolved:"), F.array_join(parts, "/")))
        .when(is_item, F.concat(source, F.lit(":unresolved")))
        .when(F.size(parts) > 0, F.concat(source, F.lit(":path:"), F.array_join(F.slice(parts, 1, 3), "/")))
        .otherwise(F.concat(source, F.lit(":unknown")))
    )


def record_id(df: DataFrame, source: Column, manifest: Column, line: Column) -> Column:
    """A namespaced id: a declared one, else the audio path, else the line."""
    declared = first_present(*(field(df, f) for f in ("record_id", "key", "id", "item_id")))
    audio = first_present(*(field(df, f) for f in ("audio_path_raw", "audio_path", "audio", "wav_path")))
    return F.concat(source, F.lit(":"), F.coalesce(declared, F.concat(F.lit("audio:"), slashed(audio)), F.concat(manifest, F.lit(":"), line.cast("string"))))


def raw_identifier(df: DataFrame, line: Column) -> Column:
    value, _ = audio_value(df)
    return F.coalesce(first_present(*(field(df, f) for f in ("key", "id", "utt_id", "item_name"))), value, F.concat(F.lit("line:"), line.cast("string")))


def identity_variants(values: list[Column], sources: list[str]) -> Column:
    """All forms of an identity: as it is, before a double colon, and that without one of the sources' prefixes; sorted, each once."""
    raw = F.filter(F.transform(F.array(*values), lambda v: strip(text(v))), lambda v: v != "")

    def forms(v: Column) -> Column:
        base = F.substring_index(v, "::", 1)
        bare = F.lit(None).cast("string")
        for s in reversed(sources):
            bare = F.when(base.startswith(f"{s}:"), F.substr(base, F.lit(len(s) + 2))).otherwise(bare)
        return F.array_compact(F.array(v, base, bare))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(raw, forms))))


def stable_key(*candidates: Column) -> Column:
    return F.lower(slashed(first_present(*candidates)))


def stable_index(value: Column, n: Column) -> Column:
    """The first 8 bytes of SHA-256, high byte first, modulo n."""
    head = F.conv(F.substring(F.sha2(value, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(head, n.cast("decimal(20,0)")).cast("int")


def path_key(c: Column) -> Column:
    """A path for comparisons: lower case, without slashes at its end."""
    return F.lower(F.rtrim(slashed(c), F.lit("/")))


def audio_key(c: Column) -> Column:
    """A path for comparisons, dot parts collapsed."""
    return F.lower(collapse(c))


def safe_component(c: Column, fallback: str) -> Column:
    """A part of a file name: word characters, dots and hyphens, 80 at most."""
    clean = F.btrim(F.regexp_replace(text(c), "[^A-Za-z0-9._-]+", "_"), F.lit("._"))
    return F.coalesce(F.nullif(F.left(clean, F.lit(80)), F.lit("")), F.lit(fallback))


def destination_name(tag: Column, source: Column, identifier: Column, audio: Column) -> Column:
    """A file name of source, id and a digest of what it stands for, with the audio's suffix."""
    suffix = F.lower(F.regexp_extract(audio, "[^/\\\\.][^/\\\\]*(\\.[^./\\\\]+)$", 1))
    suffix = F.when(F.length(suffix).between(1, 12), suffix).otherwise(".wav")
    digest = F.left(F.sha2(F.concat_ws("|", F.coalesce(tag, F.lit("None")), source, identifier, audio), 256), F.lit(12))
    return F.concat(safe_component(source, "source"), F.lit("__"), safe_component(identifier, "item"), F.lit("__"), digest, suffix)
