"""Equivalent SQL of the registered queries, for DuckDB over the same tables.

Written on its own from the definitions, not generated from the Spark side.
"""

from __future__ import annotations

SUFFIX = "Let''s decompose the question to sub-questions and solve them step by step."


def _species(key: str, values: str) -> str:
    return f"(list_value({values}))[({key} % 8 + 1)::int]"


SCIENTIFIC = (
    "'Caenorhabditis elegans','Homo sapiens','Danio rerio','Mus musculus',"
    "'Saccharomyces cerevisiae','Rattus norvegicus','Gallus gallus','Canis lupus'"
)
COMMON = "'worm','human','zebrafish','mouse','yeast','rat','chicken','dog'"


def _sequence(number: str) -> str:
    text = f"({number})::varchar"
    for digit, pair in enumerate("AA AC AG AT CA CC CG CT GA GC".split()):
        text = f"replace({text}, '{digit}', '{pair}')"
    return text


def _strip(text: str) -> str:
    return f"trim({text}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _plain(text: str) -> str:
    return f"replace({_strip(text)}, 'Answer: ', '')"


def _token(text: str) -> str:
    return f"nullif(regexp_extract({_strip(text)}, '(\\S*)$', 1), '')"


def _place(text: str) -> str:
    token = _token(text)
    return f"case when contains({token}, 'chr') then {token} else 'chr' || {token} end"


def _normalised(text: str) -> str:
    """Normalised answer as a list."""
    named = " ".join(
        f"when '{s}' then '{c}'"
        for s, c in zip(
            SCIENTIFIC.replace("'", "").split(",")[:-1],
            COMMON.replace("'", "").split(",")[:-1],
        )
    )
    plain = _plain(text)
    single = f"""case
        when task = 'Protein-coding genes'
            then case {plain} when 'Yes' then 'TRUE' when 'No' then 'NA' else {plain} end
        when task = 'Multi-species DNA aligment'
            then case {plain} {named} else {plain} end
        when task in ('SNP location', 'Gene location') then {_place(text)}
        else {plain} end"""
    return f"""case
        when task in ('Gene disease association', 'Disease gene location')
            then string_split({plain}, ', ')
        when ({single}) is not null then list_value({single}) end"""


def _labels(values: str) -> str:
    return f"list_distinct(list_transform({values}, lambda x: lower({_strip('x')})))"


def _recall(p: str, g: str) -> str:
    return (
        f"(len(list_intersect({_labels(p)}, {_labels(g)}))::double / len({_labels(g)}))"
    )


def _region_score(p: str, g: str) -> str:
    p, g = f"lower({_strip(p)})", f"lower({_strip(g)})"
    return (
        f"case when {p} = {g} then 1.0 when split_part({p}, ':', 1) = "
        f"split_part({g}, ':', 1) then 0.5 else 0.0 end"
    )


def _exact(p: str, g: str) -> str:
    return f"case when lower({_strip(p)}) = lower({_strip(g)}) then 1.0 else 0.0 end"


def _py_list(values: str) -> str:
    return f"'[''' || array_to_string({values}, ''', ''') || ''']'"


def _scored(source: str, coded: bool = False) -> str:
    location = _recall("string_split(p[1], '')", "string_split(g[1], '')") if coded else _recall("p", "g")
    listed = "task in ('Gene disease association', 'Disease gene location')"
    bad = "or task = 'Disease gene location'" if coded else ""
    return f"""
      select *, case when ok and {listed} then {_py_list('p')} when ok then p[1] end as processed_prediction,
        case when not ok then 0.0
          when task = 'Gene disease association' then {_recall('p', 'g')}
          when task = 'Disease gene location' then {_recall('p', 'g')}
          when task = 'Gene location' then {location}
          when task = 'Human genome DNA aligment' then {_region_score('p[1]', 'g[1]')}
          else {_exact('p[1]', 'g[1]')} end::double as score,
        ok as success,
        case when not called then 'no_answer' when p is null or g is null then 'not_normalised'
          when not ok then 'not_scored' else 'ok' end as status
      from (select *, called and p is not null and g is not null and not (false {bad}) as ok
        from (select *, {_normalised('raw_prediction')} as p, {_normalised('answer')} as g
          from (select * {{exclude}}, {{called}} as called from {source})))
    """


SCORED_PREDS = _scored("preds").format(
    exclude="exclude (success)", called="raw_prediction is not null and success"
)
SCORED_MIXED = _scored("mixed").format(exclude="", called="raw_prediction is not null")
SCORED_MIXED_CODED = _scored("mixed", coded=True).format(
    exclude="", called="raw_prediction is not null"
)

_NAME = _species("p_partkey", SCIENTIFIC)
_COMMON = _species("p_partkey", COMMON)

CTES = {
    "gene": """select p_partkey uid, 'GENE' || p_partkey symbol,
        'ENSG' || lpad(p_partkey::varchar, 11, '0') ensembl,
        case when p_size % 7 = 0 then null else (p_size % 22 + 1)::varchar end chromosome,
        case when p_type = 'PROMO' then 'non-protein coding' else 'protein coding' end gene_type,
        case when p_partkey % 3 = 0 then null else p_name || ' of ' || p_brand end summary
        from part""",
    "gene_alias": """select p_name alias, p_partkey uid from part
        union all select 'GENE' || p_partkey, p_partkey from part""",
    "gene_disease": "select p_brand || ' ' || p_type disease, p_partkey uid from part",
    "snp": """select 'rs' || o_orderkey rsid,
        case when o_orderkey % 11 = 0 then null else (o_custkey % 22 + 1)::varchar end chr
        from orders""",
    "snp_gene": """select distinct 'rs' || l_orderkey rsid, l_partkey uid from lineitem""",
    "reports": f"""select p_partkey query_id, {_sequence('p_partkey')} seq,
        case when p_partkey % 13 = 5 then 'RID = Q' || p_partkey || chr(10) || 'Status=WAITING'
          when p_partkey % 13 = 7 then 'Status=FAILED'
          when p_partkey % 13 = 9 then 'RID = Q' || p_partkey || chr(10) || 'No hits found'
          else 'ready' end state,
        {_NAME} name, (p_size % 22 + 1)::varchar chromosome
        from part""",
    "report_fields": f"""select query_id, seq, state,
        case when state = 'Status=FAILED' then null else 'Q' || query_id end request_id,
        case when state = 'ready' then 'ready' when state like '%WAITING' then 'waiting'
          when state like '%FAILED' then 'failed' else 'no_hits' end status,
        case when state = 'ready' then 'chr' || chromosome || ':' || (query_id * 100) || '-' ||
          case when query_id % 2 = 0 then query_id * 100 + 127 else query_id * 100 + 60 end
          else 'NA' end region,
        case when state = 'ready' then 'chr' || chromosome || ':' || (query_id * 100) || '-' ||
          (query_id * 100 + 60) else 'NA' end region_coded,
        case when state = 'ready' then '  ' || name || ' chromosome ' || chromosome
          else 'NA' end first_hit,
        case when state <> 'ready' or name = 'Canis lupus' then 'NA' else common end organism,
        case when state <> 'ready' then 'NA' when name = 'Canis lupus' then name
          else common end organism_name,
        case when state = 'ready' then 'GENE' || query_id end gene
        from (select *, {_species('query_id', COMMON)} common from reports)""",
    "items": """select uid * 10 + 1 id, 'Gene location' task,
          'Which chromosome is ' || symbol || ' gene located on human genome?' question,
          coalesce('chr' || chromosome, 'NA') answer from gene
        union all select uid * 10 + 2, 'Gene name conversion',
          'Convert ' || ensembl || ' to official gene symbol.', symbol from gene
        union all select uid * 10 + 3, 'Protein-coding genes',
          'Is ' || symbol || ' a protein-coding gene?',
          case when gene_type like '%non-protein%' then 'NA' else 'TRUE' end from gene""",
    "preds": """select id, task, question, answer,
        case (id - id % 10) % 50 when 0 then 'Answer: ' || answer
          when 10 then '  ' || lower(answer) || ' ' when 20 then answer || '9'
          when 30 then answer else null end raw_prediction,
        (id - id % 10) % 50 <> 40 success from items""",
    "mixed": f"""select p_partkey * 10 + 1 id, 'SNP location' task,
          case when p_partkey % 17 = 0 then ' ' || chr(10)
            else 'It is located on ' || (p_size % 22 + 1) || chr(10) end raw_prediction,
          'chr' || (p_size % 22 + 1) answer from part
        union all select p_partkey * 10 + 2, 'Gene location',
          case when p_partkey % 17 = 0 then ' ' || chr(10) else 'chr' || (p_size % 11 + 1) end,
          'chr' || (p_size % 22 + 1) from part
        union all select p_partkey * 10 + 3, 'Gene disease association',
          'Answer: GENE' || p_partkey || ', GENE' || (p_partkey + 1) || ', GENE' || p_partkey,
          'GENE' || p_partkey || ', gene' || (p_partkey + 1) || ', GENE' || (p_partkey + 2) from part
        union all select p_partkey * 10 + 4, 'Disease gene location',
          'chr' || (p_size % 22 + 1) || ', chr' || ((p_size + 3) % 22 + 1),
          'chr' || (p_size % 22 + 1) || ', chr' || ((p_size + 5) % 22 + 1) from part
        union all select p_partkey * 10 + 5, 'Protein-coding genes',
          case when p_partkey % 2 = 0 then 'Answer: Yes' else 'No' end,
          case when p_partkey % 3 = 0 then 'NA' else 'TRUE' end from part
        union all select p_partkey * 10 + 6, 'Multi-species DNA aligment',
          'Answer: ' || {_NAME}, {_COMMON} from part
        union all select p_partkey * 10 + 7, 'Human genome DNA aligment',
          'chr' || (p_size % 22 + 1) || ':' || (p_partkey * 100),
          'chr' || (case when p_partkey % 4 = 0 then (p_size + 1) % 22 + 1 else p_size % 22 + 1 end)
            || ':' || (p_partkey * 100 + p_partkey % 2) from part
        union all select p_partkey * 10 + 8, 'Gene alias',
          ' Answer: gene' || p_partkey || chr(9),
          'GENE' || (case when p_partkey % 5 = 0 then p_partkey + 1 else p_partkey end) from part""",
    "regions": """select o_orderkey id,
        'chr' || (o_custkey % 22 + 1) || ':' || (o_orderkey * 100) || '-' || (o_orderkey * 100 + 127) answer,
        'chr' || (case when o_orderkey % 3 = 2 then (o_custkey + 1) % 22 + 1 else o_custkey % 22 + 1 end)
          || ':' || s || '-' || (s + 127) raw_prediction
        from (select *, case when o_orderkey % 3 = 0 then o_orderkey * 100 else o_orderkey * 100 + 1 end s
          from orders)""",
    "questions": f"""select p_partkey * 100 + n id, kind, pre || arg || post ||
          case when multi then ' {SUFFIX}' else '' end question, pre || arg || post question_key, arg
        from (select p_partkey, unnest([
          {{'n': 0, 'kind': 'alias', 'pre': 'What is the official gene symbol of ', 'arg': p_name, 'post': '?', 'multi': false}},
          {{'n': 1, 'kind': 'disease_genes', 'pre': 'What are genes related to ', 'arg': p_brand || ' ' || p_type, 'post': '?', 'multi': false}},
          {{'n': 2, 'kind': 'gene_chr', 'pre': 'Which chromosome is ', 'arg': 'GENE' || p_partkey, 'post': ' gene located on human genome?', 'multi': false}},
          {{'n': 3, 'kind': 'align', 'pre': 'Align the DNA sequence to the human genome:', 'arg': {_sequence('p_partkey')}, 'post': '', 'multi': false}},
          {{'n': 4, 'kind': 'organism', 'pre': 'Which organism does the DNA sequence come from:', 'arg': {_sequence('p_partkey')}, 'post': '', 'multi': false}},
          {{'n': 5, 'kind': 'ensembl', 'pre': 'Convert ', 'arg': 'ENSG' || lpad(p_partkey::varchar, 11, '0'), 'post': ' to official gene symbol.', 'multi': false}},
          {{'n': 6, 'kind': 'coding', 'pre': 'Is ', 'arg': 'GENE' || p_partkey, 'post': ' a protein-coding gene?', 'multi': false}},
          {{'n': 9, 'kind': 'seq_alias', 'pre': 'What are the aliases of the gene that contains this sequnece:', 'arg': {_sequence('p_partkey')}, 'post': '.', 'multi': true}},
          {{'n': 10, 'kind': 'disease_loc', 'pre': 'List chromosome locations of the genes related to ', 'arg': p_brand || ' ' || p_type, 'post': '.', 'multi': true}}
        ], recursive := true) from part)
        union all
        select o_orderkey * 100 + n id, kind, pre || arg || post ||
          case when multi then ' {SUFFIX}' else '' end, pre || arg || post, arg
        from (select o_orderkey, unnest([
          {{'n': 7, 'kind': 'snp_gene', 'pre': 'Which gene is SNP ', 'arg': 'rs' || o_orderkey, 'post': ' associated with?', 'multi': false}},
          {{'n': 8, 'kind': 'snp_chr', 'pre': 'Which chromosome does SNP ', 'arg': 'rs' || o_orderkey, 'post': ' locate on human genome?', 'multi': false}},
          {{'n': 11, 'kind': 'snp_fn', 'pre': 'What is the function of the gene associated with SNP ', 'arg': 'rs' || o_orderkey, 'post': '?', 'multi': true}}
        ], recursive := true) from orders)""",
    "disease_top": """select disease, uid, row_number() over (partition by disease order by uid) rnk
        from gene_disease""",
    "disease_gold": """select disease, list('GENE' || uid order by rnk) answers
        from disease_top where rnk <= 10 group by disease""",
    # --- answers per key, by kind
    "alias_answers": """select alias, min_by(symbol, uid) answer
        from (select *, row_number() over (partition by alias order by uid) rnk from gene_alias)
        join gene using (uid) where rnk <= 3 group by alias""",
    "book": """select 'alias' kind, alias arg, answer from alias_answers
        union all select 'disease_genes', disease, array_to_string(answers, ', ') from disease_gold
        union all select 'gene_chr', symbol, 'chr' || chromosome from gene
        union all select 'ensembl', ensembl, symbol from gene
        union all select 'coding', symbol,
          case when gene_type like '%non-protein%' then null else 'TRUE' end from gene
        union all select 'snp_gene', rsid, string_agg(symbol, ', ' order by uid)
          from snp_gene join gene using (uid) group by rsid
        union all select 'snp_chr', rsid, 'chr' || chr from snp
        union all select 'align', seq, case status when 'failed' then 'Error: BLAST job failed.'
          when 'waiting' then 'Error: Timed out waiting for BLAST result.' else region end
          from report_fields
        union all select 'organism', seq, case status when 'failed' then 'Error: BLAST job failed.'
          when 'waiting' then 'Error: Timed out waiting for BLAST result.' else organism end
          from report_fields
        union all select 'seq_alias', seq, answer from report_fields
          left join alias_answers on alias_answers.alias = report_fields.gene
        union all select 'disease_loc', disease,
          string_agg(chromosome, ', ' order by rnk) filter (chromosome is not null)
          from disease_top join gene using (uid) where rnk <= 10 group by disease
        union all select 'snp_fn', rsid, min_by(summary, uid) filter (summary <> '')
          from snp_gene join gene using (uid) group by rsid""",
    "answered": """select q.id, q.kind, q.arg, coalesce(b.answer, 'NA') predicted,
        case when coalesce(b.answer, 'NA') = 'NA' then 'missing'
          when b.answer like 'Error: %' then 'error' else 'ok' end status
        from questions q left join book b on q.kind = b.kind and q.arg = b.arg""",
    # --- model texts
    "tool_text": """select event_id id, case
        when event_id % 4 = 0 then 'done ' || event_id
        when event_id % 8 = 1 then '```json' || chr(10) || '[{"name": "' || event_type ||
          '", "parameters": ' || props || '}]' || chr(10) || '```'
        when event_id % 8 = 2 then '{"name": "' || event_type || '", "parameters": {}}'
        when event_id % 8 = 3 then '[{"name": "click"}]'
        when event_id % 8 = 5 then '[{"name": "' || event_type ||
          '", "parameters": {"page": "p"}}, {"name": "view", "parameters": 7}]'
        else '[{"name": "' || event_type || '", "parameters": ' || props || '}]' end answer
        from events""",
    "calls": """select event_id id, 0 pos, event_type as name, true ok,
          json_extract_string(props, '$.k') k, null::varchar page
          from events where event_id % 8 in (1, 6, 7)
        union all select event_id, 0, event_type, true, null, 'p' from events where event_id % 8 = 5
        union all select event_id, 1, 'view', false, null, null from events where event_id % 8 = 5""",
    "checked_calls": """select *, array_to_string(list_sort(list_filter(req, lambda x: not list_contains(given, x))), '|') missing,
          array_to_string(list_sort(list_filter(given, lambda x: known and not list_contains(allowed, x))), '|') extra
        from (select *, name in ('click', 'view', 'purchase', 'signup') known,
          list_filter([case when k is not null then 'k' end, case when page is not null then 'page' end],
            lambda x: x is not null) given,
          case name when 'click' then ['k'] when 'view' then ['k', 'page'] else []::varchar[] end req,
          case name when 'click' then ['k'] when 'view' then ['k', 'page'] when 'signup' then ['k']
            else []::varchar[] end allowed
          from calls)""",
    "call_errors": """select *, case when not ok then 'invalid arguments' when not known then 'unknown tool'
        when missing <> '' then 'missing arguments' when extra <> '' then 'extra arguments' end error
        from checked_calls""",
    "structured_raw": """select event_id id, event_type, user_id, case event_id % 6
        when 0 then 'not json'
        when 1 then '{"task":"' || event_type || '","question":"q"}'
        when 2 then '{"task":"' || event_type || '","question":"q","answer":' || user_id || '}'
        when 3 then '{"task":"' || event_type || '","question":"q","answer":"' || user_id || '","explanation":null}'
        else '{"task":"' || event_type || '","question":"q","answer":"' || user_id || '"}' end raw
        from events""",
    "run_results": """select event_id id, ts, user_id % 5 model, event_type task,
        event_type <> 'error' success,
        case when event_type = 'error' then 0.0 else least(value / 100, 1.0) end::double score
        from events""",
    "verdicts": """select l.doc_id, l.quality, d.n_chars n from labels l join documents d using (doc_id)""",
    "vectors": "select vec_id id, embedding::double[] v, label from embeddings",
    "components": """select id, label, unnest(v) x, generate_subscripts(v, 1) - 1 dim from vectors""",
    "pooled": """select id, dim % 8 dim, sum(case when dim // 8 <= id % 8 then x else 0 end)
        / (id % 8 + 1) x from components group by id, dim % 8""",
    "pooled_vectors": "select id, list(x order by dim) v from pooled group by id",
    "disease_preds": f"""select p_partkey id, case p_partkey % 10 when 0 then q || ' Really?'
          when 1 then ' ' || q || ' {SUFFIX}' else q end question, 'GENE' || p_partkey predicted_answer,
          case p_partkey % 10 when 0 then q || ' Really?' else q end question_key
        from (select *, 'What are genes related to ' || p_brand || ' ' || p_type || ' ' || p_partkey // 1000 || '?' q
          from part)""",
    "part_gold": """select p_brand || ' ' || p_type || ' ' || p_partkey // 1000 disease,
        list('GENE' || p_partkey order by p_partkey) answers from part group by 1""",
    "disease_pairs": """select d.id, d.question_key, d.predicted_answer, g.gold_answer,
        case when g.gold_answer is null then 'No gold answer found' end note
        from disease_preds d left join
          (select 'What are genes related to ' || disease || '?' k, unnest(answers) gold_answer from part_gold) g
        on d.question_key = g.k""",
    "scored_preds": SCORED_PREDS,
    "scored_mixed": SCORED_MIXED,
    "scored_mixed_coded": SCORED_MIXED_CODED,
    "texts": """select *, array_to_string(p, ', ') pt, array_to_string(g, ', ') gt
        from scored_preds""",
    "distances": """select *, levenshtein(pt, gt) d,
        case when greatest(length(pt), length(gt)) = 0 then 1.0
          else 1.0 - levenshtein(pt, gt)::double / greatest(length(pt), length(gt)) end ratio
        from (select id, task, case when raw_prediction is null then null else pt end pt, gt, score from texts)""",
    "cosines": """select a.id, list_cosine_similarity(a.v, b.v) c
        from vectors a left join vectors b on b.id = a.id + 1""",
}

_ALL = ",\n".join(f"{name} as ({body})" for name, body in CTES.items())
ORACLE: dict[str, str] = {}


def _sql(name: str, body: str) -> None:
    ORACLE[name] = f"with {_ALL}\n{body}"


def _board(source: str) -> str:
    return f"""select task, grouping(task)::int is_total, count(*) items,
        round(avg(success::int), 6) success_rate, round(sum(score), 6) score_sum,
        round(avg(score), 6) score from {source} group by rollup (task)"""


# === sources and sinks ===
_sql(
    "nested_benchmark_items",
    """select row_number() over (order by id // 1000, id % 10, id) - 1 id, task, question,
    case when id % 10 = 2 then answer || '|x' else answer end answers,
    (case when id % 10 = 2 then 2 else 1 end)::int n from items""",
)
_sql(
    "typed_question_items",
    """select row_number() over (order by uid) - 1 id, gene_type task,
    'What is ' || symbol || '?' question, case when uid % 5 <> 0 then symbol end answer,
    case when uid % 5 <> 0 then symbol || '|' || ensembl else '' end answers from gene""",
)
_sql(
    "nested_files_accounted",
    """select row_number() over (order by id // 1000, id % 10, id) - 1 id, task, question,
      case when id % 10 = 2 then answer || '|x' else answer end answers,
      null::bigint block, null::varchar part, null::varchar reason
    from items where id // 1000 % 5 in (0, 3, 4)
    union all
    select null, null, null, null, block, case when block % 5 = 3 then 'Broken' end,
      case when block % 5 = 3 then 'another shape' else 'no object of tasks' end
    from (select distinct id // 1000 block from items) where block % 5 in (1, 2, 3)""",
)
_sql(
    "list_files_accounted",
    """select row_number() over (order by uid) - 1 id, gene_type task, 'What is ' || symbol || '?' question,
      symbol answer, null::bigint block, null::varchar part, null::varchar reason
    from gene where uid // 50 % 3 <> 1
    union all
    select distinct null::bigint, null, null, null, uid // 50, 'questions', 'another shape'
    from gene where uid // 50 % 3 = 1""",
)
_sql(
    "reply_files_accounted",
    """select kind, case when state = 0 then null when state = 1 then shape
        when kind = 'gene_xml' and state = 2 then 'no XML'
        when state = 3 and kind in ('search', 'link', 'gene_xml') then 'no JSON line' else 'no JSON' end reason,
      sum(n)::bigint n
    from (select unnest(['search', 'link', 'gene_xml', 'summary', 'snp']) kind,
            unnest(['no list of ids', 'no sets of links', 'no XML', 'no records', 'no records']) shape) kinds,
      (select uid % 4 state, count(*) n from gene group by 1) counts
    group by 1, 2""",
)
_sql(
    "predictions_round_trip",
    """select id, task, question, coalesce(raw_prediction, '') answer,
    case when id % 3 = 0 then 'said "' || task || '"' || chr(10) end explanation, success from preds""",
)
_sql(
    "paired_round_trip",
    """select task, question, raw_prediction predicted,
    case when id % 10 = 2 then answer || '|x' else answer end gold from preds""",
)
_sql(
    "paired_documents_round_trip",
    """select task, '"' || question || '"' || chr(10) question, raw_prediction predicted, answer || '|x' gold
    from preds""",
)
_sql(
    "results_round_trip",
    """select id, task, question || chr(10) || '"q", x' question, answer,
    case when success then raw_prediction end raw_prediction, processed_prediction, score, success
    from scored_preds""",
)
_sql(
    "run_log_metrics",
    """select 'all' run_id, key, 0::bigint step, round(value, 6) as value from (
    select 'success_rate' as key, avg(success::int) as value from run_results
    union all select 'overall_score', avg(score) from run_results
    union all select 'score_' || replace(task, ' ', '_'), avg(score) from run_results group by task)""",
)
_sql(
    "repeated_run_log",
    """select 'model-' || model run_id, coalesce('score_' || task, 'overall_score') as key, step::bigint step,
      round(avg(score) / (step + 1), 6) as value from run_results, (values (0), (1)) as s(step)
    group by grouping sets ((model, task, step), (model, step))""",
)
_sql(
    "metrics_of_tagged_runs",
    """select 'model-' || model run_id, coalesce('score_' || task, 'overall_score') as key,
    round(avg(score), 6) as value from run_results where model % 2 = 0
    group by grouping sets ((model, task), (model))""",
)
_sql(
    "search_reply_hits",
    "select disease term, rnk::int as rank, uid::varchar uid from disease_top where rnk <= 10",
)
_sql(
    "summary_reply_records",
    """select uid::varchar uid, symbol as name, chromosome, symbol official_symbol,
    ensembl official_full_name, gene_type description, 'Homo sapiens' organism, summary from gene""",
)
_sql(
    "snp_reply_records",
    """select o_orderkey::varchar rsid, (o_custkey % 22 + 1)::varchar chr,
    case o_orderkey % 4 when 0 then 'G' || o_custkey when 1 then 'G' || o_custkey || ', H'
      when 2 then 'G' || o_custkey || ', NA' else 'NA' end genes from orders""",
)
_sql(
    "link_reply_genes",
    """select o_orderkey::varchar rsid, pos::int pos,
    case pos when 0 then o_custkey::varchar when 1 then '5' else o_custkey || '7' end gene_uid
    from orders, (select unnest([0, 1, 2]) pos) where o_orderkey % 7 not in (3, 5)""",
)
_sql(
    "gene_xml_types",
    "select uid, case when uid % 4 <> 0 then gene_type end gene_type from gene",
)

# === projections, filters, samples ===
_sql("item_table", "select id, task, question, answer from items")
_sql(
    "sampled_items",
    "select id, task, question, answer from items order by md5('7:' || id), id limit 50",
)
_sql("first_items", "select id, task, question, answer from items order by id limit 50")
_sql(
    "valid_score_rows",
    "select id, task, round(score, 6) score from run_results where task <> 'error' and id % 10 <> 3",
)
_sql("question_keys", "select id, question_key from questions")
_sql("flat_answers", "select disease, array_to_string(answers, ' ') answer from part_gold")
_sql(
    "list_literals",
    """select id, (case when id % 10 = 2 then 2 else 1 end)::int n,
    case id % 10 when 2 then answer || '|b c' when 3 then '[broken ' || answer || ']' else answer end answers
    from items""",
)
_sql("benchmark_rows", "select id, task, question question_key, answer, 1::int n from items")
_sql(
    "model_backends",
    """select id, case model when 0 then 'qwen3:4b' when 1 then 'deepseek-r1:8b'
    else 'hosted-' || model end model, case when model < 2 then 'local' else 'hosted' end backend
    from run_results""",
)
_sql(
    "distinct_answer_labels",
    """select id, (case when lower(answer) = answer then 2 else 3 end)::int n,
    task || '|' || answer || case when lower(answer) = answer then '' else '|' || lower(answer) end answers
    from preds""",
)
_sql(
    "shared_answer_labels",
    """select task, raw_prediction label from preds intersect select task, answer from items""",
)

# === prompts ===
_SHOTS = """select task, string_agg('user: ' || question || ' / assistant: ' || answer, ' / ' order by id) examples
    from (select *, row_number() over (partition by task order by id) n from items) where n <= 4 group by task"""
_sql("few_shot_sets", _SHOTS)
_sql(
    "few_shot_messages",
    f"""select id, 'system: You answer briefly. / ' || examples || ' / user: ' || question messages
    from items join ({_SHOTS}) using (task)""",
)
_sql(
    "literal_shot_messages",
    """select id, 'system: You answer briefly. / user: Convert ENSG1 to official gene symbol. / assistant: GENE1 / user: '
    || question messages from items""",
)
_sql(
    "structured_prompts",
    """select id, 'Here is a question: "' || question || '".' || chr(10) ||
    '    Return the answer in valid JSON format matching this schema:' || chr(10) ||
    '    {"task": str, "question": str, "answer": str, "explanation": Optional[str]}.' || chr(10) ||
    '    The ''task'' should be ''' || task || '''.' || chr(10) || '    ' prompt from items""",
)
_sql(
    "appended_turns",
    """select conv_id, turn, role, text from conversations
    union all select conv_id, n, 'assistant', '[{"name": "search"}]' from
      (select conv_id, max(turn) + 1 n, count(*) filter (turn = 0) z from conversations group by 1) where z > 0
    union all select conv_id, n + 1, 'tool', 'result for ' || conv_id from
      (select conv_id, max(turn) + 1 n, count(*) filter (turn = 0) z from conversations group by 1) where z > 0""",
)
_sql(
    "tool_message_lists",
    """select conv_id, (turn * 3)::bigint turn, role, text,
      case when role = 'assistant' and turn % 4 = 1 then 'search{"k": ' || turn || '}|open{}' end calls,
      null::bigint reply_turn, null::int reply_place from conversations
    union all
    select conv_id, turn * 3 + place + 1, 'tool', 'result of ' || name, null, turn * 3, place
    from conversations, (values (0, 'search'), (1, 'open')) as c(place, name)
    where role = 'assistant' and turn % 4 = 1""",
)
_sql(
    "tool_result_turns",
    """select id, pos::int pos, 'user' as role, 'Function ' || name || ' called with parameters ' ||
    case when page is not null then '{"page":"p"}' else '{"k":"' || k || '"}' end || ' and returned r' || id as text
    from calls where ok""",
)
_sql(
    "judge_prompts",
    """select id, 'Grade one answer to a question.' || chr(10) || chr(10) || 'Question: ' || question || chr(10) ||
    'Answer: ' || coalesce(raw_prediction, '') || chr(10) || 'Reference: ' || answer || chr(10) ||
    'Rubric: Correctness of the answer.' || chr(10) || chr(10) ||
    'Give 1 (worst) to 5 (best) and a reason, in these two lines:' || chr(10) ||
    'Score: X' || chr(10) || 'Explanation: ...' || chr(10) prompt from preds""",
)
_sql(
    "pairwise_prompts",
    """select id, 0::int model_a, 1::int model_b, 'Question:' || chr(10) || question || chr(10) || chr(10) ||
    'Response A:' || chr(10) || answer || chr(10) || chr(10) || 'Response B:' || chr(10) ||
    coalesce(raw_prediction, '') || chr(10) || chr(10) || 'Criteria:' || chr(10) || 'accuracy' || chr(10) ||
    chr(10) || 'Return your answer in this format:' || chr(10) || 'Choice: A or B' || chr(10) ||
    'Rationale: ...' || chr(10) prompt from preds""",
)

# === collecting and parsing answers ===
_sql(
    "batch_answers",
    """select id, case when id % 7 <> 3 then 'chr' || length(question) end raw_prediction,
    id % 7 <> 3 success, (case when id % 7 = 3 then 2 else 1 end)::int attempts,
    case when id % 7 = 3 then 'ValueError: no reply' end error from items""",
)
_sql(
    "distinct_call_answers",
    """select p_partkey, p_name alias, case when p_name not like '%e' then upper(p_name) end raw_prediction,
    p_name not like '%e' success, (case when p_name like '%e' then 3 else 1 end)::int attempts,
    case when p_name like '%e' then 'TimeoutError: slow' end error from part""",
)
_sql(
    "structured_answers",
    """select id, case when id % 6 >= 3 then event_type else '' end task,
    case when id % 6 >= 3 then 'q' else '' end question,
    case when id % 6 >= 3 then user_id::varchar else '' end answer,
    case when id % 6 >= 3 then null else '' end explanation, id % 6 >= 3 success from structured_raw""",
)
_sql(
    "structured_rejects",
    """select id, raw, case id % 6 when 0 then 'json: invalid' when 1 then 'answer: missing'
    else 'answer: type' end violations from structured_raw where id % 6 < 3""",
)
_sql(
    "schema_violations",
    """select id, 'json: invalid' violation from structured_raw where id % 6 = 0
    union all select id, 'task: enum' from structured_raw where id % 6 <> 0 and event_type = 'error'
    union all select id, 'answer: missing' from structured_raw where id % 6 = 1
    union all select id, 'answer: type' from structured_raw where id % 6 = 2
    union all select id, 'answer: length' from structured_raw where id % 6 > 2 and length(user_id::varchar) < 3""",
)
_sql(
    "first_valid_attempts",
    """select id, min_by(event_type || user_id, attempt) filter (valid) answer,
    coalesce(bool_or(valid), false) success,
    coalesce(min(attempt) filter (valid), least(max(try_no), 2)) attempts
    from (select event_id - event_id % 3 id, event_id % 3 + 1 attempt, event_id % 3 + 1 try_no, event_type, user_id,
      event_type in ('click', 'signup') and event_id % 3 + 1 <= 2 valid from events) group by id""",
)
_sql(
    "reasoning_split",
    """select event_id id, case when event_id % 3 = 0 then 'user ' || user_id || chr(10) || 'asks' else '' end thoughts,
    event_type answer from events""",
)
_sql(
    "unfenced_texts",
    """select id, case when answer like '```json%' then substr(answer, 9, length(answer) - 12) else answer end answer
    from tool_text""",
)
_sql(
    "fenced_structured_answers",
    """select id, 'so' thoughts, case when id % 6 >= 3 then event_type else '' end task,
    case when id % 6 >= 3 then user_id::varchar else '' end answer, id % 6 >= 3 success from structured_raw""",
)
_sql("tool_calls", "select id, pos::int pos, name, ok parameters_ok, k, page from calls")
_sql("direct_answers", "select id, answer from tool_text where id % 4 = 0 or id % 8 in (2, 3)")
_sql("unknown_tool_calls", "select id, pos::int pos, name from call_errors where not known")
_sql(
    "bad_tool_arguments",
    """select id, pos::int pos, name, error, missing, extra from call_errors
    where error is not null and error <> 'unknown tool'""",
)
_sql(
    "tool_usage",
    """select name, count(*) calls, count(error) errors, round(count(error)::double / count(*), 6) error_share
    from call_errors group by name""",
)
_sql(
    "final_answers",
    """select conv_id, coalesce(max_by(text, turn) filter (turn < 5 and role = 'assistant' and text <> ''),
      'Max turns reached, and a final textual answer was not formulated by the assistant.') answer,
    bool_or(turn < 5 and role = 'assistant' and coalesce(text, '') <> '') answered
    from conversations group by conv_id""",
)
ORACLE["final_answers_in_five_turns"] = ORACLE["final_answers"]
ORACLE["final_answers"] = ORACLE["final_answers"].replace("turn < 5 and ", "")

# === reports ===
for _name, _columns in {
    "report_request_ids": "request_id",
    "report_statuses": "status",
    "report_regions": "region",
    "report_regions_as_coded": "region_coded region",
    "report_first_hits": "first_hit",
    "report_organisms": "organism, organism_name",
    "report_genes": "gene",
}.items():
    _sql(_name, f"select query_id, {_columns} from report_fields")

# === routing and lookups ===
_sql("question_kinds", "select id, kind from questions")
_sql("question_arguments", "select id, arg from questions")
_sql(
    "question_kinds_as_coded",
    f"""select id, case when kind = 'disease_loc' then 'disease_genes' else kind end kind,
    case when kind = 'disease_loc' then 'sub-questions and solve them step by step.'
      when kind = 'seq_alias' then arg || '. {SUFFIX.rstrip(".")}'
      when kind = 'align' or kind = 'organism' then arg
      when kind = 'disease_genes' then trim(string_split(question, 'to')[-1], '? ')
      when kind = 'alias' then trim(string_split(question, 'of')[-1], '? ')
      else arg end arg from questions""",
)
_sql(
    "single_hop_kinds",
    """select case when kind in ('disease_loc', 'seq_alias', 'snp_fn') then
      case kind when 'disease_loc' then 'disease_genes' else 'unknown' end else kind end kind,
    count(*) questions from questions group by 1""",
)
for _name, _kind in {
    "alias_symbols": "alias",
    "disease_gene_names": "disease_genes",
    "gene_chromosomes": "gene_chr",
    "identifier_symbols": "ensembl",
    "snp_gene_names": "snp_gene",
    "snp_chromosomes": "snp_chr",
    "protein_coding_flags": "coding",
    "sequence_regions": "align",
    "sequence_organisms": "organism",
    "sequence_aliases": "seq_alias",
    "disease_locations": "disease_loc",
    "snp_functions": "snp_fn",
}.items():
    _sql(_name, f"select id, arg, predicted, status from answered where kind = '{_kind}'")
_sql("snp_gene_rows", "select rsid, uid rnk, symbol as name from snp_gene join gene using (uid)")
_sql("all_lookup_answers", "select id, kind task, kind, predicted, status from answered")
_KIND_TASKS = """case kind when 'alias' then 'Gene alias' when 'disease_genes' then 'Gene disease association'
      when 'gene_chr' then 'Gene location' when 'align' then 'Human genome DNA aligment'
      when 'organism' then 'Multi-species DNA aligment' when 'ensembl' then 'Gene name conversion'
      when 'coding' then 'Protein-coding genes' when 'snp_gene' then 'Gene SNP association'
      when 'snp_chr' then 'SNP location' when 'seq_alias' then 'Sequence gene alias'
      when 'disease_loc' then 'Disease gene location' else 'SNP gene function' end"""
_LOOKUP_GOLD = f"""select a.id, {_KIND_TASKS} task, a.predicted raw_prediction,
      case when kind in ('alias', 'disease_genes', 'ensembl', 'seq_alias') then 'GENE' || p_partkey
        when kind in ('gene_chr', 'disease_loc')
          then case when p_size % 7 <> 0 then 'chr' || (p_size % 22 + 1) else 'NA' end
        when kind = 'align'
          then 'chr' || (p_size % 22 + 1) || ':' || (p_partkey * 100) || '-' || (p_partkey * 100 + 127)
        when kind = 'organism' then {_species("p_partkey", SCIENTIFIC)}
        when kind = 'coding' then case when p_type = 'PROMO' then 'NA' else 'TRUE' end
        when kind = 'snp_gene' then coalesce('GENE' || first_part, 'NA')
        when kind = 'snp_chr' then case when o_orderkey % 11 <> 0 then 'chr' || (o_custkey % 22 + 1) else 'NA' end
        else coalesce(summary, 'NA') end answer
    from answered a
    left join part p on kind not in ('snp_gene', 'snp_chr', 'snp_fn') and p.p_partkey = a.id // 100
    left join (select o_orderkey, o_custkey, first_part, summary from orders
      left join (select l_orderkey, min(l_partkey) first_part from lineitem group by 1) on l_orderkey = o_orderkey
      left join gene g on g.uid = first_part) o
      on kind in ('snp_gene', 'snp_chr', 'snp_fn') and o.o_orderkey = a.id // 100"""
_sql(
    "lookup_scoreboard",
    f"""select task, grouping(task)::int is_total, count(*) items, round(avg(success::int), 6) success_rate,
      round(sum(score), 6) score_sum, round(avg(score), 6) score, round(avg(d), 6) edit_distance
    from (select task, success, score, levenshtein(array_to_string(p, ', '), array_to_string(g, ', ')) d
      from ({_scored(f"({_LOOKUP_GOLD})").format(exclude="", called="true")}))
    group by rollup (task)""",
)
_sql(
    "listed_lookup_pairs",
    """select id, kind task, array_to_string(string_split(predicted, ', '), '|') answers,
      len(string_split(predicted, ', '))::int n
    from answered where kind in ('disease_loc', 'gene_chr')""",
)

# === normalisation and scoring ===
_sql(
    "normalised_answers",
    """select id, task, len(p)::int n, array_to_string(p, '|') normalised
    from (select id, task, """
    + _normalised("raw_prediction")
    + " p from mixed)",
)
_sql(
    "exact_matches",
    f"""select id, case when raw_prediction is null then null else {_exact('raw_prediction', 'answer')} end::double score
    from preds""",
)
_sql(
    "set_recalls",
    f"""select id, round({_recall('p', 'g')}, 6) score from (select id,
    string_split({_plain('raw_prediction')}, ', ') p, string_split({_plain('answer')}, ', ') g from mixed)""",
)
_sql(
    "character_recalls",
    f"""select id, case when raw_prediction is null then null else
    round({_recall("string_split(raw_prediction, '')", "string_split(answer, '')")}, 6) end score from preds""",
)
_sql(
    "region_matches",
    f"select id, ({_region_score('raw_prediction', 'answer')})::double score from regions",
)
_sql(
    "location_set_recalls",
    "select id, round(score, 6) score from scored_mixed where task = 'Disease gene location'",
)
for _name, _source in {
    "task_scores": "scored_mixed",
    "task_scores_as_coded": "scored_mixed_coded",
}.items():
    _sql(
        _name,
        f"select id, task, processed_prediction, round(score, 6) score, success, status from {_source}",
    )
_sql(
    "item_scores",
    """select id, case when success then raw_prediction end raw_prediction, score,
    case when success then score end score_on_success, success from scored_preds""",
)
_sql("edit_distances", "select id, d::int edit_distance from distances")
_sql("fuzzy_ratios", "select id, case when pt is null then null else round(ratio, 6) end fuzzy_ratio from distances")
for _name in ("pooled_vectors", "pooled_vectors_from_rows"):
    _sql(_name, "select id, dim::int dim, round(x, 6) as value from pooled")
_sql(
    "unit_vectors",
    """select id, dim::int dim, round(x / sqrt(sum(x * x) over (partition by id)), 6) as value from components""",
)
_sql(
    "sentence_similarities",
    """select a.id, round(list_cosine_similarity(a.v, b.v), 6) cosine_similarity
    from pooled_vectors a left join pooled_vectors b on b.id = a.id + 1""",
)
_sql("cosine_pairs", "select id, round(c, 6) cosine_similarity from cosines")
_sql("mean_cosine", "select round(avg(c), 6) mean_cosine, count(c) pairs from cosines")
_sql(
    "scores_with_context",
    """select d.id, score, d::int edit_distance,
    case when pt is null then null else round(ratio, 6) end fuzzy_ratio, round(c, 6) cosine_similarity
    from distances d left join cosines c on c.id = d.id // 10""",
)
_sql(
    "similarity_report",
    """select 'Question ' || a.id || '?' question, 'label ' || e.label predicted_answer, g.gold_answer,
    case when g.id is not null then round(list_cosine_similarity(a.v, b.v), 6) end cosine_similarity,
    case when g.id is null then 'No gold answer found' end note
    from vectors a join embeddings e on e.vec_id = a.id left join (
      select id - 1 id, 'gold ' || unnest(case when (id - 1) % 5 = 0 then [1, 2] else [1] end) gold_answer
      from vectors where (id - 1) % 3 <> 0) g on g.id = a.id
    left join vectors b on b.id = a.id + 1""",
)
_sql(
    "structured_success_by_task",
    """select event_type task, count(*) answers, count(*) filter (id % 6 < 3) failures,
    round(avg((id % 6 >= 3)::int), 6) success_rate from structured_raw group by event_type""",
)
_sql(
    "nearest_vectors",
    """select query_id, doc_id, place::int place, round(s, 6) similarity from (
    select *, row_number() over (partition by query_id order by s desc, doc_id) place from (
      select c.label query_id, d.id doc_id, round(list_cosine_similarity(c.v, d.v), 12) s
      from (select label, list(x order by dim) v from
        (select label, dim, avg(x) x from components group by 1, 2) group by 1) c, vectors d))
    where place <= 5""",
)

_sql(
    "index_recall",
    """select count(*) filter (id % 100 = 0) queries,
      (count(*) filter (id % 100 = 0) * least(10, count(*)))::bigint neighbours, true reached from vectors""",
)

# === pairing ===
_sql("pairs_by_id", "select id, raw_prediction, answer gold_answer from preds")
_sql("pairs_by_question", "select id, question_key, predicted_answer, gold_answer, note from disease_pairs")
_sql(
    "unmatched_predictions",
    """select id, question_key, predicted_answer, gold_answer, null::double score, note
    from disease_pairs where gold_answer is null""",
)
_sql(
    "best_gold_scores",
    """select id, round(max(s), 6) best_score, round(avg(s), 6) mean_score, count(s) gold_answers
    from (select id, 1.0 - levenshtein(predicted_answer, gold_answer)::double
      / greatest(length(predicted_answer), length(gold_answer)) s from disease_pairs) group by id""",
)

# === aggregations ===
_sql("scoreboard", _board("scored_preds"))
_sql("folded_scoreboard", _board("run_results"))
_sql("ordered_scoreboard", _board("scored_mixed"))
_sql("success_rate", "select round(avg(success::int), 6) success_rate from scored_mixed")
_sql("overall_score", "select round(avg(score), 6) overall_score from scored_mixed")
_sql("score_by_task", "select task, round(avg(score), 6) score from scored_mixed group by task")
_sql(
    "edit_distance_by_task",
    """select task, grouping(task)::int is_total, round(avg(d), 6) edit_distance, count(d) pairs
    from (select task, d from distances) group by rollup (task)""",
)
_sql(
    "metrics_long",
    """select 'success_rate' as key, round(avg(success::int), 6) as value from scored_preds
    union all select 'overall_score', round(avg(score), 6) from scored_preds
    union all select 'score_' || replace(task, ' ', '_'), round(avg(score), 6) from scored_preds group by task""",
)
_sql(
    "chart_table",
    """select task, round(avg(score), 6) score,
    (select round(avg(score), 6) from run_results) overall_score from run_results group by task""",
)
_MODELS = ", ".join(
    f"round(avg(score) filter (model = {m}), 6) score_{m}" for m in range(5)
)
_sql(
    "model_comparison",
    f"""select task, {_MODELS}, round(avg(score) filter (model = 4) - avg(score) filter (model = 0), 6) difference
    from run_results group by task""",
)
_sql(
    "tool_gain_by_benchmark",
    """select benchmark, task, round(w, 6) without_tools, round(m, 6) with_tools, round(m - w, 6) difference
    from (select case when id % 3 = 0 then 'multi' else 'single' end benchmark, task,
      avg(score) filter (model < 3) w, avg(score) filter (model >= 3) m from run_results group by 1, 2)""",
)
_sql(
    "model_cube",
    """select model, task, grouping(model, task)::int margin, count(*) items, round(avg(score), 6) score
    from run_results group by cube (model, task)""",
)
_sql(
    "item_coverage",
    """select task, grouping(task)::int is_total, count(*) items,
    count(*) filter (success) answered, round(avg(success::int), 6) coverage from preds group by rollup (task)""",
)
_sql(
    "threshold_bands",
    """select model, task, round(c, 6) coverage, round(e, 6) exact_match, (case
      when c >= 1 and e > 0.20 then 5 when c >= 1 and e > 0.15 then 4 when c > 0.90 and e > 0.10 then 3
      when c > 0.75 and e > 0.05 then 2 when c > 0.50 and e > 0.01 then 1 else 0 end)::int points
    from (select model, task, avg(success::int) c, avg((score >= 0.9)::int) e from run_results group by 1, 2)""",
)
_sql(
    "band_points_by_scheme",
    """select model, task, (case
      when model % 2 = 0 then case when c >= 1 and e > 0.1 then 9 when c > 0.9 then 3
                                   when c > 0.75 and e > 0.05 then 2 else 0 end
      when model = 1 then case when c >= 0.99 then 4 when c > 0.5 and e > 0.01 then 1 else 0 end
      else 0 end)::int points
    from (select model, task, avg(success::int) c, avg((score >= 0.9)::int) e from run_results group by 1, 2)""",
)
_sql(
    "unioned_runs",
    """select id, task, case when model < 2 then round(score, 6) end score,
    case when model >= 2 then success end success from run_results""",
)
_sql("pending_items", "select id, task from preds where not success")
_sql(
    "running_scores",
    """select model run, id, count(*) over w items,
    floor(sum(round(score * 10000)) over w / count(*) over w * 100 + 0.5) / 1e6 score from run_results
    window w as (partition by model order by id rows between unbounded preceding and current row)""",
)

# === ranking ===
_sql("top_disease_candidates", "select disease, uid from disease_top where rnk <= 10")
_sql(
    "first_present_summaries",
    """select disease, min_by(summary, uid) filter (summary is not null) summary
    from gene_disease join gene using (uid) group by disease""",
)

# === judging ===
_sql(
    "judge_scores",
    """select quality, count(*) verdicts, round(avg(case when n % 9 > 1 then n % 5 + 1 end), 6) judge_score,
    round(avg((n % 9 <= 1)::int), 6) unreadable from verdicts group by quality""",
)
_sql(
    "win_rates",
    """with best as (select task, id // 5 block, max(score) filter (model = 0) a,
      max(score) filter (model = 1) b, max(score) filter (model = 2) c from run_results group by 1, 2),
    pairs as (select 0 ma, 1 mb, (a >= b)::int won from best where a is not null and b is not null
      union all select 0, 2, (a >= c)::int from best where a is not null and c is not null)
    select ma::int model, mb::int opponent, count(*) comparisons, round(avg(won), 6) win_rate from pairs group by 1, 2
    union all select mb::int, ma::int, count(*), round(avg(1 - won), 6) from pairs group by 1, 2""".replace(
        "with best as", "select * from (with best as", 1
    )
    + ")",
)

# === streaming ===
for _name in ("streamed_scoreboard", "windowed_scoreboard"):
    _sql(
        _name,
        """select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') window_start, task, count(*) items,
        round(avg(success::int), 6) success_rate, round(avg(score), 6) score
        from run_results group by 1, 2""",
    )
