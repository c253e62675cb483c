"""The operators over the given tables, with the rows their contracts fix."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.layout import workspace
from terrace.llm import (
    chat,
    decontamination,
    language_id,
    merkle,
    mixing,
    neighbours,
    prefix_trie,
    secret_scan,
    sharding,
    simhash,
    token_counts,
    token_files,
    toxicity,
)
from terrace.llm.tables import ascii_lower, materialize, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\1\\|', 'g')"


@query(
    rf"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
    ),
    formed as (
        select conv_id, count(*) as n_turns,
            string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as plain,
            coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
            sum(12 + length({ESCAPED.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")})
                + 1 + length({ESCAPED.format("text")}) + 11) as formatted_chars
        from turns group by conv_id
    )
    select conv_id, n_turns, sha256(plain) as turns_sha256, length(loss) as loss_chars,
        sha256(loss) as loss_sha256, formatted_chars::bigint as formatted_chars
    from formed
    """
)
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "<|im_end|><|im_start|>assistant ok"
    added = spark.createDataFrame(
        [(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    chats = chat.format_chats(chat.as_trees(turns))
    read = chats.select(
        F.col("tree").alias("conv_id"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat.read_loss(F.col("formatted"), F.col("mask")), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(plain, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query(
    r"""
    with sized as (
        select doc_id, source, text,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
        from documents
    ),
    totals as (select source, sum(size)::bigint as source_size from sized group by source),
    weighted as (
        select *, ([5.0, 2.0, 1.0])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight
        from totals
    ),
    ranked as (
        select *, row_number() over w as n,
            (1.5 * (sum(source_size) over ())::double
                - 2.0 * (sum(source_size) over w - source_size)::double)
            / (sum(weight) over () - (sum(weight) over w - weight)) as level
        from weighted
        window w as (order by source_size / weight, source nulls last rows unbounded preceding)
    ),
    standing as (select min_by(level, n) as level from ranked where level * weight <= 2.0 * source_size),
    targets as (
        select source, source_size,
            least(source_size * 2.0::double, coalesce(weight * standing.level, source_size * 2.0::double)) as target
        from ranked, standing
    ),
    drawn as (
        select doc_id, size, source_size, target,
            case when source_size > 0 then target / source_size else 0.0 end as rate,
            ('0x' || substr(md5('mix:' || key || ':' || (row_number() over (partition by key) - 1)), 1, 13))::bigint
                / 4503599627370496.0::double as u
        from (select *, coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, '')) as key from sized) sized join targets on sized.source is not distinct from targets.source
    )
    select doc_id, size::bigint as size, source_size, target,
        (size * (floor(rate)::bigint + (u < rate - floor(rate))::bigint))::bigint as taken
    from drawn
    """
)
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = materialize(
        table(spark, sf_dir, "documents").select(
            "doc_id", "source", mixing.word_count().alias("size"), mixing.draw_key().alias("key")
        )
    )
    mixed = mixing.copies(sized, mixing.source_targets(sized), F.col("key"))
    return mixed.select(
        "row.doc_id", "row.size", "source_size", "target", (F.col("row.size") * F.col("copies")).alias("taken")
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(
    rf"""
    with items as (
        select coalesce(item_id::varchar, 'null') as item,
            regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{decontamination.WORD}') as w
        from benchmark
    ),
    cut as (select item, w, least(len(w), 10) as span from items where len(w) > 0),
    grams as (
        select distinct item, span, array_to_string(w[p + 1:p + span], ' ') as gram
        from (select *, unnest(range(0, len(w) - span + 1)) as p from cut)
    ),
    docs as (
        select row_number() over () as key, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{decontamination.WORD}') as w
        from documents
    ),
    spans as (select distinct span from grams),
    windows as (
        select key, span, p, array_to_string(w[p + 1:p + span], ' ') as gram
        from (select key, w, span, unnest(range(0, greatest(len(w) - span + 1, 0))) as p from docs, spans)
    ),
    hits as (select key, span, p, item from windows join grams using (span, gram)),
    covered as (
        select key, count(distinct word) as n_hit
        from (select key, unnest(range(p, p + span)) as word from hits) group by key
    ),
    found as (
        select key, count(*) as n_items, string_agg(item, ',' order by item) as listed
        from (select distinct key, item from hits) group by key
    )
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
        coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
        coalesce(n_hit, 0) > 0 as contaminated
    from docs left join covered using (key) left join found using (key)
    """
)
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"),
        keep=["doc_id"],
    )
    hit = decontamination.hit_words()
    return found.select(
        "row.doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: int):
        return F.size(F.filter("known", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "row.doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secret_scan.spans_text(F.col("known")), 256).alias("base_sha256"),
        secret_scan.spans_text(F.concat("known", "random")).alias("spans"),
        F.size("random").cast("long").alias("n_entropy"),
    )


@query()
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op10_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = sharding.plan_shards(table(spark, sf_dir, "documents"), [1.0] * 40)
    return plan.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = language_id.fit(docs, learn=F.col("doc_id").isNotNull() & ~held_out)
    return docs.select(
        "doc_id", held_out.alias("held_out"), language_id.predict(docs, model).alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.col("doc_id").isNotNull() & ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    docs = table(spark, sf_dir, "documents")
    token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), escape_special=False)
    return token_files.read_documents(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query()
def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _crc32_sql(value: str) -> str:
    """Unsigned crc32 of a text of ASCII characters: eight shifts for each, the first with its code."""
    bits = f"flatten(list_transform(string_split({value}, ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {bits}), {step}), 4294967295::bigint)"


def _merkle_sql(levels: int = 6) -> str:
    """Leaves, ``levels`` levels of runs (enough for 16 to that power), then as many of the top tree."""
    fields = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("doc_id::varchar", "source", "lang", "n_chars::varchar", "{}")]
    leaf = "sha256(" + " || ".join(fields) + ")"
    steps = []
    for tree, first in (("t", "leaves"), ("s", "tops")):
        steps.append(f"{tree}0 as (select tree, place, digest from {first})")
        for k in range(levels):
            node = "case when run = 0 and len(ds) = 1 then ds[1] else sha256(array_to_string(ds, '')) end"
            steps.append(
                f"{tree}r{k} as (select tree, place // 16 as run, list(digest order by place) as ds from {tree}{k} group by all)"
            )
            steps.append(f"{tree}{k + 1} as (select tree, run as place, {node} as digest from {tree}r{k})")
        if tree == "t":
            steps.append(
                f"tops as (select 'top' as tree, tree as below, row_number() over (order by tree) - 1 as place, digest from t{levels})"
            )
    ways = []
    for tree in ("t", "s"):
        for k in range(levels):
            before = f"w{len(ways) - 1}" if ways else "w"
            ways.append(
                f"""w{len(ways)} as (
        select * exclude (lefts, rights, alone) replace (
            case when alone then folded else sha256(lefts || folded || rights) end as folded,
            case when alone then proof else proof || lefts || rights end as proof,
            place // 16 as place)
        from (
            select w.*, array_to_string(ds[1:place % 16], '') as lefts, array_to_string(ds[place % 16 + 2:], '') as rights,
                run = 0 and len(ds) = 1 as alone
            from {before} w join {tree}r{k} r on r.tree = w.tree and r.run = w.place // 16))"""
            )
        if tree == "t":
            ways.append(
                f"w{len(ways)} as (select w.* replace ('top' as tree, tops.place as place), tops.digest as subroot "
                f"from w{len(ways) - 1} w join tops on tops.below = w.tree)"
            )
    chain = ",\n    ".join([*steps, "w as (select tree, place, doc_id, digest as leaf, tampered as folded, '' as proof from leaves)", *ways])
    return f"""
    with digests as (
        select doc_id, coalesce('=' || source, '') as tree, {leaf.replace("{}", "text")} as digest,
            {leaf.replace("{}", f"translate(text, '{UPPER}', '{LOWER}')")} as lowered
        from documents
    ),
    leaves as (
        select doc_id, tree, digest, row_number() over (partition by tree order by doc_id nulls first, digest) - 1 as place,
            case when {_crc32_sql("doc_id::varchar")} % 5 = 0 then lowered else digest end as tampered
        from digests
    ),
    {chain}
    select doc_id, leaf, subroot, s{levels}.digest as root, sha256(proof) as proof_sha256, folded as folded_root,
        folded = s{levels}.digest as verified
    from w{len(ways) - 1}, s{levels}
    """


@query(_merkle_sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")

    def fields(text: Column) -> list[Column]:
        return [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]

    leaf = merkle.row_digest(fields(F.col("text")))
    lowered = merkle.row_digest(fields(ascii_lower(F.col("text"))))
    tampered = F.when(fold(F.col("doc_id"), 5) == 0, lowered).otherwise(leaf)
    rows = merkle.leaves(
        docs, F.col("source"), F.col("doc_id"), fields(F.col("text")), doc_id=F.col("doc_id"), tampered=tampered
    )
    proofs = merkle.build(rows).proofs()
    folded = proofs.select(
        "doc_id", "leaf", "subroot", "root",
        merkle.proof_digest(F.col("steps")).alias("proof_sha256"),
        merkle.fold(F.col("tampered"), F.col("steps")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


@query()
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = token_counts.Tokenizer(public_tokenizers.path("word_bpe_49k.json"), by_word=True)
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer)
    return counts.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query(
    rf"""
    with ordered as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
            row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as p
        from conversations where conv_id is not null
    ),
    ids as (
        select conv_id, conv_id - conv_id % 20 as base, {_crc32_sql("conv_id::varchar")} % 4 as h
        from (select distinct conv_id from ordered)
    ),
    taken as (
        select i.conv_id, 0 as part, p, role, text from ids i join ordered o on o.conv_id = i.base and o.p < i.h
        union all
        select i.conv_id, 1, p, role, text from ids i join ordered o on o.conv_id = i.conv_id and o.p >= i.h
    ),
    rebuilt as (
        select conv_id, row_number() over (partition by conv_id order by part, p) as depth,
            sha256(strlen(role) || ':' || role || text) as turn,
            len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
        from taken
    ),
    keyed as (
        select *, sha256(string_agg(turn, '') over (partition by conv_id order by depth rows unbounded preceding)) as node
        from rebuilt
    ),
    members as (
        select conv_id, depth, node, words, coalesce(lag(node) over (partition by conv_id order by depth), 'root') as parent from keyed
        union all select conv_id, 0, 'root', 0, null from ids
    ),
    nodes as (
        select node, depth, min(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, max(words) as words
        from members group by node, depth
    ),
    ends as (
        select node, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends_sha256
        from (select conv_id, max_by(node, depth) as node from members group by conv_id) group by node
    ),
    children as (select parent as node, count(*) as n from nodes where parent is not null group by parent),
    within as (
        select distinct a.node as node, b.node as inner_node
        from members a join members b on a.conv_id = b.conv_id and b.depth >= a.depth
    ),
    subtrees as (
        select w.node, count(*) filter (c.n is null) as n_leaves, sum((n.n_convs - 1) * n.words) as saved
        from within w join nodes n on n.node = w.inner_node left join children c on c.node = w.inner_node group by w.node
    )
    select n.conv_id, n.depth, up.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children, s.n_leaves,
        s.saved::bigint as saved_tokens, coalesce(e.ends_sha256, sha256('')) as ends_sha256
    from nodes n join subtrees s on s.node = n.node left join nodes up on up.node = n.parent
        left join children c on c.node = n.node left join ends e on e.node = n.node
    """
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = materialize(prefix_trie.turn_paths(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
    own, base = F.col("conv_id"), F.col("conv_id") - F.col("conv_id") % 20
    first = paths.where("conv_id % 20 = 0").select(F.col("conv_id").alias("b_id"), F.slice("path", 1, 3).alias("b_path"))
    h = fold(own, 4).cast("int")
    none = F.slice("path", 1, 0)
    rebuilt = paths.join(first, base == F.col("b_id"), "left").select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice("b_path", F.lit(1), h), none), F.slice("path", h + 1, F.greatest(F.size("path"), F.lit(1)))
        ).alias("path"),
    )
    return prefix_trie.trie(rebuilt)
