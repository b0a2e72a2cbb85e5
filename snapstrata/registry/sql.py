"""SQL texts of the registered queries, by query name."""

from __future__ import annotations

from snapstrata.plans import customers as preset
from snapstrata.registry import binding, queries
from snapstrata.registry import oracle as o
from snapstrata.registry.binding import DAYS, LATEST, Defects

RAW = ", ".join(preset.COLUMNS)


def _plain(columns) -> str:
    out = []
    for c in columns:
        if c in o.MONEY:
            out.append(f"cast({c} as double) as {c}")
        elif c in o.FLAGS:
            out.append(f"cast({c} as integer) as {c}")
        elif c == "data_cadastro":
            out.append(f"{o.iso(c)} as {c}")
        else:
            out.append(c)
    return ", ".join(out)


TYPED = _plain([f.name for f in preset.FIELDS])
DIA = f"{o.iso('dia')} as dia"
CLEAN = [c for c in queries.MEASURES if c != queries.DAY]


def _summary(days) -> str:
    rows = " union all ".join(
        f"select dia, {o.quoted(code)} as regra, {o.quoted(o.ACTIONS[n[0]][0])} as severidade, "
        f"{o.quoted('ANONIMIZAR_CAMPO' if n == 'a003' else o.ACTIONS[n[0]][1])} as acao, count(*) as total, "
        f"cast(sum(cast({n} as bigint)) as bigint) as falhas from flags group by dia"
        for n, code in o.RULE_CODES.items()
    )
    return f"{o.through('flags', days)}, res as ({rows})"


def _gate(name: str, defects: Defects) -> str:
    return (
        f"select * from ({o.through('flags', (LATEST,), defects)} select {o.quoted(name)} as carga, count(*) as total, "
        "sum(cast(bloqueado as bigint))::bigint as bloqueadas from flags)"
    )


def _state_columns(*, message: bool) -> str:
    return (
        f"{o.iso('data_carga')} as data_carga, arquivo, status, tentativas, impressao, linhas_bronze, linhas_silver, "
        f"linhas_quarentena, run_id_ultimo" + (", mensagem" if message else "")
    )


LOG = """
log as (
  select event_id as execucao_id, user_id as run_id, event_type as etapa,
    case when event_type = 'error' then 'ERRO' else 'SUCESSO' end as status, ts as inicio_ts,
    cast(value as decimal(12,2)) as duracao_seg from events),
ultima as (select run_id from log order by inicio_ts desc, execucao_id desc limit 1)"""

ERRORS = """
erros as (
  select event_id as erro_id, user_id as run_id, case when event_type = 'error' then 'ERRO' else 'AVISO' end as severidade,
    ts as erro_ts, props as mensagem from events where event_type in ('error', 'signup'))"""

CALENDAR = f"""
  select cast(strftime(d, '%Y%m%d') as integer) as sk_data, strftime(d, '%Y-%m-%d') as data,
    cast(extract(year from d) as integer) as ano, case when extract(month from d) <= 6 then 1 else 2 end as semestre,
    cast(extract(quarter from d) as integer) as trimestre, cast(extract(month from d) as integer) as mes,
    [{', '.join(o.quoted(m) for m in preset.MONTHS)}][extract(month from d)] as nome_mes,
    strftime(d, '%Y-%m') as ano_mes, cast(extract(day from d) as integer) as dia,
    cast(extract(isodow from d) as integer) as dia_semana,
    [{', '.join(o.quoted(m) for m in preset.WEEKDAYS)}][extract(isodow from d)] as nome_dia_semana,
    cast(extract(week from d) as integer) as semana_ano, cast(extract(isodow from d) >= 6 as integer) as fim_de_semana
  from (select unnest(range(min(o_orderdate)::date::timestamp, max(o_orderdate)::date::timestamp + interval 1 day, interval 1 day)) as d from orders)"""

DATES_UNTIL_2029 = """
datas as (
  select cast(unnest(range(min(o_orderdate)::date::timestamp, timestamp '2030-01-01', interval 1 day)) as date) as d from orders)"""


def _apply(dim: str, source: str, day, name: str) -> str:
    """One load applied to a dimension, case by case."""
    d = o.day(day)
    attrs = [*preset.CARRIED, "hash_atributos"]
    t = ", ".join(f"t.{c}" for c in attrs)
    s = ", ".join(f"s.{c}" for c in attrs)
    cur = f"(select * from {dim} where flag_atual) t"
    return f"""
{name} as (
  select id_cliente, {', '.join(attrs)}, inicio_vigencia, fim_vigencia, flag_atual from {dim} where not flag_atual
  union all select t.id_cliente, {t}, t.inicio_vigencia, t.fim_vigencia, true from {cur} left join {source} s using (id_cliente)
    where s.id_cliente is null or s.hash_atributos = t.hash_atributos
  union all select t.id_cliente, {s}, t.inicio_vigencia, t.fim_vigencia, true from {cur} join {source} s using (id_cliente)
    where s.hash_atributos <> t.hash_atributos and t.inicio_vigencia = {d}
  union all select t.id_cliente, {t}, t.inicio_vigencia, cast({d} - interval 1 day as date), false from {cur} join {source} s using (id_cliente)
    where s.hash_atributos <> t.hash_atributos and t.inicio_vigencia < {d}
  union all select t.id_cliente, {s}, {d}, date '9999-12-31', true from {cur} join {source} s using (id_cliente)
    where s.hash_atributos <> t.hash_atributos and t.inicio_vigencia < {d}
  union all select s.id_cliente, {s}, {d}, date '9999-12-31', true from {source} s
    where s.id_cliente not in (select id_cliente from {dim} where flag_atual))"""


def _same_day_fix() -> str:
    again = f"""
outra as (
  select * replace (case when id_cliente % 5 = 0 then 'Divorciado' else estado_civil end as estado_civil)
  from silver where dia = {o.day(LATEST)} and id_cliente % 7 <> 0)"""
    fixed = o.versions("outra", "refeita")
    source = "\nfonte as (select * from refeita_s)"
    return (
        o.through("silver", DAYS) + "," + o.versions() + "," + again + "," + fixed + "," + source + ","
        + _apply("dim", "fonte", LATEST, "nova") + f" select {o.VERSION_COLUMNS} from nova"
    )


def _domain(domain, value: str, label: str, kind: str) -> str:
    return o.star() + "," + o.domain_fact(domain, value, label, kind)


KPI = """
kpi as (
  select cast(strftime(dia, '%Y%m%d') as integer) as sk_data_carga, count(*) as clientes, sum(total_gasto) as gasto,
    cast(sum(total_gasto) as double) / count(total_gasto) as ticket, avg(cast(comprou as integer)) as conversao,
    avg(qtd_campanhas_aceitas) as campanhas, cast(sum(salario_anual) as double) / count(salario_anual) as salario, avg(idade) as idade
  from fato group by dia)"""

FACT_COLUMNS = f"""id_cliente, {o.ymd('dia')} as sk_data_carga, {o.ymd('data_cadastro')} as sk_data_cadastro, idade, faixa_etaria,
  {o.double('salario_anual')} as salario_anual, dias_desde_ultima_compra, visitas_website_mes, qtd_compras_desconto,
  {', '.join(preset.CHANNEL_COUNTS)}, total_compras, {o.double('total_gasto')} as total_gasto, qtd_campanhas_aceitas,
  cast(comprou as integer) as comprou"""


def _members(column: str, where: str = "true", source: str = "silver") -> str:
    return f"select {column} from {source} where {where} union select {o.quoted(preset.NOT_GIVEN)}"


def _level(c: str) -> str:
    whens = " ".join(f"when {o.quoted(k)} then {v}" for k, v in preset.EDUCATION_ORDER.items())
    return f"case {c} {whens} else 99 end"


def _orphan(column: str, condition: str) -> str:
    return f"select {o.quoted(column)} as coluna, sum(case when {condition} then 1 else 0 end)::bigint as orfas from fato"


def _checks() -> str:
    not_in_days = "cast(strftime({c}, '%Y-%m-%d') as date) not in (select d from datas)"
    parts = {
        "V01 primeira carga com sucesso": ("e1 = 'SUCESSO'", "e1"),
        "V01 ultima carga com sucesso": ("e2 = 'SUCESSO'", "e2"),
        "V02 a carga trouxe linhas": ("b > 0", "b"),
        "V03 toda linha aceita ou retida": ("b = s + q", "b || ' / ' || (s + q)"),
        "V04 um fato por cliente aceito": ("s = f", "s || ' / ' || f"),
        "V05 6 linhas por cliente": ("g = 6 * f", "g || ' / ' || f"),
        "V06 3 linhas por cliente": ("c = 3 * f", "c || ' / ' || f"),
        "V07 5 linhas por cliente": ("p = 5 * f", "p || ' / ' || f"),
        "V08 mesmo gasto nos dois fatos": ("tf = tg", "tf || ' / ' || tg"),
        "V09 uma versao aberta": ("v9 = 0", "v9"),
        "V10 intervalos em ordem": ("v10 = 0", "v10"),
        "V11 todo fato acha os membros": ("v11 = 0", "v11"),
        "V12 todo fato acha as datas": ("v12 = 0", "v12"),
        "V13 sem etapa com erro": ("v13 = 0", "v13"),
        "V14 versoes sem intervalo entre si": ("v14 = 0", "v14"),
        "V15 chave de versao sem repeticao": ("v15 = 0", "v15"),
    }
    long = [
        o.domain_fact(preset.CATEGORIES, "valor_gasto", "categoria", "decimal(12,2)", name="lg"),
        o.domain_fact(preset.CHANNELS, "qtd_compras", "canal", "integer", name="lc"),
        o.domain_fact(preset.CAMPAIGNS, "aceitou", "campanha", "integer", name="lp"),
    ]
    rows = " union all ".join(
        f"select {o.quoted(n)} as verificacao, cast({ok} as integer) as ok, cast({d} as varchar) as detalhe from n"
        for n, (ok, d) in parts.items()
    )
    d3 = o.day(LATEST)
    return f"""{o.star()}, {','.join(long)}, {DATES_UNTIL_2029}, {LOG}, {o.deliveries()}, {o.load_state()},
seguinte as (select *, lead(inicio_vigencia) over (partition by id_cliente order by inicio_vigencia) as prox from dim),
n as (select
  (select count(*) from raw where dia = {d3}) as b, (select count(*) from silver where dia = {d3}) as s,
  (select count(*) from flags where bloqueado and dia = {d3}) as q, (select count(*) from fato) as f,
  (select count(*) from lg) as g, (select count(*) from lc) as c, (select count(*) from lp) as p,
  (select cast(cast(sum(total_gasto) as decimal(38,2)) as varchar) from fato) as tf,
  (select cast(cast(sum(valor_gasto) as decimal(38,2)) as varchar) from lg) as tg,
  (select count(*) from (select id_cliente from dim where flag_atual group by 1 having count(*) > 1)) as v9,
  (select count(*) from dim where inicio_vigencia > fim_vigencia) as v10,
  (select count(*) from fato where {not_in_days.format(c='data_cadastro')} or {not_in_days.format(c='dia')}) as v12,
  (select status from estado order by data_carga limit 1) as e1, (select status from estado order by data_carga desc limit 1) as e2,
  (select count(*) from fato f where id_cliente not in (select id_cliente from dim) or pais is null or escolaridade is null or estado_civil is null) as v11,
  (select count(*) from (select id_cliente, inicio_vigencia from dim group by all having count(*) > 1)) as v15,
  (select count(*) from log where status = 'ERRO' and run_id = (select max(user_id) from events)) as v13,
  (select count(*) from seguinte where prox <> cast(fim_vigencia + interval 1 day as date)) as v14)
{rows}"""


FEW = "select n_name as pais from nation where n_regionkey < 4 union select 'Não Informado'"

TOTALS = """
tot as (
  select case when extract(year from o_orderdate) >= 2001 then o_custkey + 10000000 else o_custkey end as id,
    count(*) as pedidos, strftime(max(o_orderdate), '%Y-%m-%d') as ultimo
  from orders group by 1),
cli as (select c_custkey as id, cast(0 as bigint) as pedidos, cast(null as varchar) as ultimo from customer)"""


def _plan(day=None, redo: bool = False) -> str:
    auto = "true" if day is None else "false"
    where = "true" if day is None else f"e.data_carga = {o.day(day)}"
    attempts = "1" if redo else "coalesce(s.tentativas, 0) + 1"
    done = "coalesce(s.status = 'SUCESSO', false)" + (" and false" if redo else "")
    return f"""{o.state(some=True)},
ult as (select max(data_carga) as ultima from estado where status = 'SUCESSO'),
pares as (
  select e.data_carga, min(x.data_carga) as copia, count(*) as copias from entregas e join estado x
  on x.impressao = e.impressao and x.data_carga <> e.data_carga group by 1),
base as (
  select e.data_carga, e.arquivo, e.impressao, s.status as st, s.tentativas as tt, u.ultima, p.copia, p.copias,
    {done} as feito, {auto} and coalesce(s.status = 'ERRO_FORA_DE_ORDEM', false) as fora,
    {auto} and coalesce(s.status like 'ERRO%', false) and coalesce(s.tentativas, 0) >= 3 as cansado,
    s.data_carga is null and coalesce(e.data_carga < u.ultima, false) as tarde, {attempts} as nova
  from entregas e left join estado s on s.data_carga = e.data_carga
  left join pares p on p.data_carga = e.data_carga cross join ult u where {where}),
dec as (select *, feito or fora or cansado as pula from base)
select {o.iso('data_carga')} as data_carga, arquivo, impressao,
  case when pula then 'pular' when tarde then 'recusar' else 'planejar' end as decisao,
  case when pula then st when tarde then 'ERRO_FORA_DE_ORDEM' else 'PENDENTE' end as status,
  cast(case when pula then tt else nova end as integer) as tentativas,
  case when not pula and tarde then 'Anterior a ultima carga com sucesso (' || {o.iso('ultima')} || ')' end as mensagem,
  {o.iso("case when not pula and not tarde then copia end")} as copia_de,
  case when not pula and not tarde then coalesce(copias, 0) else 0 end as copias,
  concat_ws(',', case when not feito and not fora and cansado then 'MAX_TENTATIVAS' end,
    case when not pula and tarde then 'ARQUIVO_FORA_DE_ORDEM' end,
    case when not pula and not tarde and copia is not null then 'ARQUIVO_CONTEUDO_DUPLICADO' end) as avisos
from dec"""


def _digits() -> tuple[str, str]:
    """A digest `h` digit by digit, in five numbers of up to 13 hex characters; and their sums as text."""

    def number(first: int, last: int) -> str:
        return " + ".join(
            f"cast(strpos('0123456789abcdef', substr(h, {i + 1}, 1)) - 1 as decimal(38,0)) * {16 ** (last - 1 - i)}" for i in range(first, last)
        )

    parts = [(at, min(at + 13, 64)) for at in range(0, 64, 13)]
    return ", ".join(f"{number(a, b)} as v{a}" for a, b in parts), " || '-' || ".join(f"cast(sum(v{a}) as varchar)" for a, _ in parts)


def _fingerprint() -> str:
    digits, sums = _digits()
    return f"""with {o.raw(DAYS)},
hs as (select dia, sha256({o.text_of(preset.COLUMNS, '||')}) as h from raw),
vs as (select dia, {digits} from hs)
select {DIA}, count(*) || '-' || {sums} as impressao from vs group by dia"""


def _profile() -> str:
    rows = []
    for table, columns in binding.SCHEMAS.items():
        for column in columns.split(", "):
            name, kind = column.split(" ")
            text = queries.DESCRIBED.get((table, name), "")
            secret = "confidencial" if name in queries.SENSITIVE else "interno"
            rows.append(
                f"select '{table}' as tabela, '{name}' as coluna, '{kind}' as tipo, count(*) as linhas, "
                f"count({name}) as preenchidas, {o.quoted(text)} as descricao, '{queries.LAYERS[table]}' as camada, "
                f"'{secret}' as classificacao from {table}"
            )
    return " union all ".join(rows)


def _inventory() -> str:
    return " union all ".join(
        f"select '{t}' as tabela, '{queries.STORAGE[t]}' as camada, count(*) as linhas from {t}" for t in binding.TABLES
    )


def _placed(sql: str, order: str) -> str:
    return f"select *, cast(row_number() over (order by {order}) as integer) as posicao from ({sql})"


def _surrogate_keys() -> str:
    text = {"pais": "pais", "escolaridade": "escolaridade", "versao": "id_cliente || '/' || dia", "data_cadastro": "cast(data_cadastro as varchar)"}
    parts = " union all ".join(
        f"select {o.quoted(n)} as dimensao, count(distinct {c}) as valores, 1::bigint as chaves_por_valor, count(distinct {c}) as chaves, 1::bigint as valores_por_chave, "
        + ("min(cast(strftime(data_cadastro, '%Y%m%d') as bigint)) as menor, max(cast(strftime(data_cadastro, '%Y%m%d') as bigint)) as maior" if n == "data_cadastro" else "null::bigint as menor, null::bigint as maior")
        + " from silver"
        for n, c in text.items()
    )
    return f"{o.through('silver', DAYS)} {parts}"


def _listed(column: str, labels) -> str:
    return f"coalesce(list_position([{', '.join(map(o.quoted, labels))}], {column}), {len(labels) + 1})"


def _domain_order(labels) -> str:
    whens = " ".join(f"when {o.quoted(x)} then {i}" for i, x in enumerate(labels))
    return f"case rotulo {whens} else {len(labels)} end, rotulo"


def _register() -> str:
    head, _ = _plan().split("select " + o.iso("data_carga") + " as data_carga, arquivo", 1)
    kept = ["tamanho_bytes", "linhas_bronze", "linhas_silver", "linhas_quarentena"]
    return head.rstrip() + f""",
novo as (select *, tarde as recusada from dec where not pula)
select {o.iso('coalesce(n.data_carga, e.data_carga)')} as data_carga,
  case when n.data_carga is not null then n.arquivo else e.arquivo end as arquivo,
  case when n.data_carga is null then e.status when n.recusada then 'ERRO_FORA_DE_ORDEM' else 'PENDENTE' end as status,
  cast(case when n.data_carga is null then e.tentativas else n.nova end as integer) as tentativas,
  case when n.data_carga is not null then n.impressao else e.impressao end as impressao, {', '.join('e.' + c for c in kept)},
  case when n.data_carga is null then e.run_id_ultimo else 'run-9' end as run_id_ultimo,
  case when n.data_carga is null then e.mensagem when n.recusada then 'Anterior a ultima carga com sucesso (' || {o.iso('n.ultima')} || ')' end as mensagem,
  case when e.data_carga is not null then 'antes' else 'agora' end as criado_em,
  case when n.data_carga is not null then 'agora' else 'antes' end as atualizado_em
from estado e full outer join novo n on n.data_carga = e.data_carga"""


def _discovery() -> str:
    return f"""with ordens as (
  select date_trunc('month', o_orderdate)::date as mes, o_orderkey || ';' || o_orderstatus as linha from orders),
hs as (select mes as dia, sha256(linha) as h, linha from ordens
  where extract(month from mes) <> 2 and mes <> (select min(mes) from ordens)),
vs as (select dia, linha, {_digits()[0]} from hs)
select case when extract(month from dia) = 3 then 'MARKETING_' else 'marketing_' end || strftime(dia, '%Y%m%d') || '.csv' as arquivo,
  sum(strlen(linha) + 1)::bigint as tamanho_bytes, {o.iso('dia')} as data_carga, count(*) || '-' || {_digits()[1]} as impressao
from vs group by dia"""


def texts() -> dict[str, str]:
    f = o.through
    d3 = o.day(LATEST)
    out = {
        "customer_snapshot": f"{f('raw')} select {RAW}, {DIA}, seq from raw",
        "contract_projection": f"{f('raw')} select {RAW} from raw",
        "audit_columns": f"{f('raw')} select id_cliente, {DIA}, 'marketing_{LATEST:%Y%m%d}.csv' as _arquivo_origem, 'run-1' as _run_id, seq from raw",
        # A file does not tell an empty text from a missing one.
        "delimited_file": f"{f('raw')}, lido as (select dia, {', '.join(f"nullif({c}, '') as {c}" for c in preset.COLUMNS)} from raw) "
        f"select {RAW}, {DIA}, 'entrega.csv' as _arquivo_origem, sha256({o.text_of(preset.COLUMNS, '||')}) as _hash_linha, (select count(*) from raw) as sequencias from lido",
        # An empty id comes back from a file as NULL.
        "row_numbers": f"{f('raw')} select nullif(id_cliente, '') as id_cliente, seq, row_number() over (order by seq) - 1 as linha from raw",
        "row_hash": f"{f('raw')} select id_cliente, seq, sha256({o.text_of(preset.COLUMNS, '||')}) as hash_linha from raw",
        "typed_customers": f"{f('typed')} select {TYPED}, {DIA}, seq, id_cliente_raw from typed",
        "quality_accepted": f"{f('silver')} select {_plain(CLEAN)}, hash_conteudo, dq_alertas, {DIA} from silver",
        "quality_quarantine": f"{f('flags')} select id_cliente_raw, {o.codes('r')} as motivos, {DIA}, r.id_cliente as original_id_cliente, r.data_cadastro as original_data_cadastro, "
        "r.salario_anual as original_salario_anual, r.pais as original_pais "
        "from flags join (select dia, seq, id_cliente, data_cadastro, salario_anual, pais from raw) r using (dia, seq) where bloqueado",
        "quality_summary": f"{_summary(DAYS)} select {DIA}, regra, severidade, acao, total, falhas, round(falhas * 100.0 / total, 6)::double as pct_falha from res",
        "quality_gate": "select *, round(bloqueadas * 100.0 / total, 6)::double as pct_rejeicao, "
        f"cast(bloqueadas * 100.0 / total <= 10 as integer) as aprovada from ({_gate('normal', Defects())} union all {_gate('suja', Defects().dirtier())})",
        "content_clones": f"{f('flags')} select seq, hash_conteudo, copias from flags",
        "first_occurrence": f"{f('flags')} select id_cliente, seq, cast(r002 as integer) as repetida from flags",
        "occurrence_number": "select event_id, user_id, row_number() over (partition by user_id order by event_id) as vez from events",
        "calendar": CALENDAR,
        "calendar_kept": CALENDAR,
        "dim_members": f"{f('silver', (DAYS[0], LATEST))} {_members('pais')}",
        "dim_marital": f"{f('silver')} {_members('estado_civil')}",
        "surrogate_keys": _surrogate_keys(),
        "dim_ordered": f"{f('silver')} select escolaridade, {_level('escolaridade')} as nivel_ordem from ({_members('escolaridade')})",
        "dim_static": "with fixo(cod_categoria, categoria) as (values "
        + ", ".join(f"({o.quoted(c)}, {o.quoted(t)})" for c, (t, _) in preset.CATEGORIES.items())
        + ") select * from fixo union all select p_type, lower(p_type) from part where p_type not in (select cod_categoria from fixo) group by 1, 2",
        "bands": f"{f('silver')} select id_cliente, {o.income_band('salario_anual')} as faixa_salarial, idade, {o.age_band('idade')} as faixa_etaria "
        "from (select *, cast(extract(year from dia) as integer) - ano_nascimento as idade from silver)",
        "scd2_history": f"{f('silver', DAYS)}, {o.versions()} select {o.VERSION_COLUMNS} from dim",
        "scd2_iterated": f"{f('silver', DAYS)}, {o.versions()} select {o.VERSION_COLUMNS} from dim",
        "scd2_same_day_fix": _same_day_fix(),
        "scd2_as_of": f"{f('silver', DAYS)}, {o.versions()} select {o.VERSION_COLUMNS} from dim where {o.day(DAYS[1])} between inicio_vigencia and fim_vigencia",
        "fact_snapshot": f"{o.star()} select {FACT_COLUMNS} from fato",
        "fact_category": f"{_domain(preset.CATEGORIES, 'valor_gasto', 'categoria', 'double')} select id_cliente, {o.ymd('dia')} as sk_data_carga, categoria, valor_gasto from longo",
        "fact_channel": f"{_domain(preset.CHANNELS, 'qtd_compras', 'canal', 'integer')} select id_cliente, {o.ymd('dia')} as sk_data_carga, canal, qtd_compras from longo",
        "fact_campaign": f"{_domain(preset.CAMPAIGNS, 'aceitou', 'campanha', 'integer')} select id_cliente, {o.ymd('dia')} as sk_data_carga, campanha, aceitou from longo",
        "kpi_delta": o.star("true") + "," + KPI + o.delta(queries.KPIS),
        "kpi_newest_two": o.star(f"s.dia <> {o.day(DAYS[1])}") + "," + KPI + o.delta(queries.KPIS),
        "category_share": f"{_domain(preset.CATEGORIES, 'valor_gasto', 'categoria', 'decimal(12,2)')}, t as (select categoria as rotulo, sum(valor_gasto) as v from longo group by 1) "
        "select rotulo, cast(v as double) as valor, round(cast(v as double) / (select cast(sum(v) as double) from t), 6) as fracao from t",
        "channel_share": f"{_domain(preset.CHANNELS, 'qtd_compras', 'canal', 'integer')}, t as (select canal as rotulo, sum(qtd_compras)::bigint as v from longo group by 1) "
        "select rotulo, v as valor, round(cast(v as double) / (select cast(sum(v) as double) from t), 6) as fracao from t",
        "campaign_rate": f"{_domain(preset.CAMPAIGNS, 'aceitou', 'campanha', 'integer')} select campanha as rotulo, round(avg(aceitou), 6) as valor, sum(aceitou)::bigint as n from longo group by 1",
        "country_spend": f"{o.star()} select pais as rotulo, count(*) as valor, cast(sum(total_gasto) as double) as gasto from fato group by 1",
        "mean_with_gaps": f"{o.star()} select pais as rotulo, count(*) as n, round(avg(cast(salario_anual as double)), 6) as valor from fato group by 1",
        "income_band": f"{o.star()} select faixa_salarial as rotulo, count(*) as n, round(avg(cast(total_gasto as double)), 6) as valor from fato group by 1",
        "age_band": f"{o.star()} select faixa_etaria as rotulo, count(*) as n, round(avg(cast(total_gasto as double)), 6) as valor from fato group by 1",
        "education_level": f"{o.star()} select escolaridade as rotulo, {_level('escolaridade')} as nivel_ordem, count(*) as n, round(avg(cast(total_gasto as double)), 6) as valor from fato group by 1, 2",
        "scd_stats": f"{f('silver', DAYS)}, {o.versions()} select count(*) as versoes, count(distinct id_cliente) as clientes, sum(case when flag_atual then 0 else 1 end)::bigint as historicas from dim",
        "loads_latest": f"{o.state()} select {_state_columns(message=True)}, tamanho_bytes, atualizado_em from estado",
        "load_totals": f"{o.state()}, u as (select * from estado where status = 'SUCESSO' order by data_carga desc limit 1) "
        "select sum(case when status = 'SUCESSO' then 1 else 0 end)::bigint as concluidas, sum(case when status like 'ERRO%' then 1 else 0 end)::bigint as com_erro, "
        "round(coalesce((select cast(linhas_quarentena as double) / linhas_bronze from u), 0), 6) as pct_quarentena from estado",
        "recent_runs": f"with {LOG} select execucao_id, run_id, etapa, status, cast(duracao_seg as double) as duracao_seg, cast(row_number() over (order by inicio_ts desc, execucao_id desc) as integer) as posicao from (select * from log order by inicio_ts desc, execucao_id desc limit 40)",
        "stage_duration": f"with {LOG} select etapa, cast(round(sum(duracao_seg), 1) as double) as seg from log where run_id = (select run_id from ultima) group by 1",
        "run_succeeded": f"with {LOG} select run_id, cast(bool_and(status = 'SUCESSO') as integer) as sucesso from log where run_id = (select run_id from ultima) group by 1",
        "recent_errors": f"with {ERRORS} select erro_id, run_id, severidade, mensagem from (select * from erros order by erro_ts desc, erro_id desc limit 15)",
        "error_summary": f"with {ERRORS} select severidade, count(*) as n from erros group by 1",
        "dq_latest": f"{_summary(DAYS)} select regra, severidade, acao, total, falhas, round(falhas * 100.0 / total, 6)::double as pct_falha, "
        f"'run-' || strftime(dia, '%Y%m%d') || '-2' as run_id from res where dia = {d3}",
        "dq_runs": f"{_summary(DAYS)} select {DIA}, regra, severidade, acao, total, falhas, round(falhas * 100.0 / total, 6)::double as pct_falha, run_id "
        "from res, (values ('run-1'), ('run-2')) runs(run_id)",
        "load_not_empty": "with o as (select cast(extract(year from o_orderdate) as integer) as ano from orders) select ano, count(*) as linhas, 'aceita' as situacao from o group by 1 "
        "union all select min(ano) - 1, 0, 'vazia' from o",
        "dq_totals": f"{_summary(DAYS)} select sum(case when severidade = 'BLOQUEANTE' then falhas else 0 end)::bigint as bloqueios, "
        "sum(case when severidade = 'ALERTA' and falhas > 0 then 1 else 0 end)::bigint as alertas_disparados, "
        f"sum(case when severidade = 'ALERTA' then 1 else 0 end)::bigint as alertas from res where dia = {d3}",
        "inventory": _inventory(),
        "profile": _profile(),
        "dictionary_coverage": f"select camada, count(*) as colunas, sum(case when descricao <> '' then 1 else 0 end)::bigint as documentadas, "
        "sum(case when classificacao = 'confidencial' then 1 else 0 end)::bigint as confidenciais, "
        "round(sum(case when descricao <> '' then 1 else 0 end) / cast(count(*) as double), 6) as fracao_documentada, "
        f"sum(preenchidas)::bigint as valores from ({_profile()}) group by camada",
        "checks_all": _checks(),
        "orphan_keys": f"{o.star()}, {DATES_UNTIL_2029}, poucos as ({FEW}) "
        + " union all ".join(
            [
                _orphan("sk_pais", "pais not in (select pais from poucos)"),
                _orphan("sk_escolaridade", "false"),
                _orphan("sk_data_carga", "dia not in (select d from datas)"),
                _orphan("sk_data_cadastro", "data_cadastro not in (select d from datas)"),
            ]
        ),
        "merge_insert_new": f"with {TOTALS} select * from cli union all select * from tot where id not in (select id from cli)",
        "merge_upsert": f"with {TOTALS} select * from tot union all select * from cli where id not in (select id from tot)",
        "merge_upsert_keep": f"{o.state()}, n as (select * replace (case when menor % 2 = 0 then data_carga else cast(data_carga + interval 10000 day as date) end as data_carga) from entregas) "
        f"select {o.iso('coalesce(n.data_carga, e.data_carga)')} as data_carga, coalesce(n.impressao, e.impressao) as impressao, "
        "case when n.data_carga is not null then 'PENDENTE' else e.status end as status, e.linhas_silver, "
        "case when e.data_carga is not null then 'antes' else 'agora' end as criado_em "
        "from estado e full outer join n on n.data_carga = e.data_carga",
        "merge_update_columns": f"with {TOTALS} select c.id, coalesce(t.pedidos, c.pedidos) as pedidos, coalesce(t.ultimo, c.ultimo) as ultimo "
        "from cli c left join (select * replace (case when pedidos > 1 then pedidos end as pedidos) from tot) t on t.id = c.id",
        "generation_replace": "select c_custkey, c_nationkey, 2 as vez from customer",
        "slice_replace": "with o as (select o_orderkey, o_orderstatus, cast(extract(year from o_orderdate) as integer) as ano from orders), a as (select min(ano) as y from o) "
        "select o_orderkey, o_orderstatus, ano, ano || '-01-01' as dia from o, a where ano not in (y + 1, y + 2) or (ano = y + 1 and o_orderstatus = 'F')",
        "load_manifest": f"with {o.deliveries()}, nomes as (select menor as tamanho_bytes, case menor % 11 "
        "when 1 then 'vendas_' || strftime(data_carga, '%Y%m%d') || '.csv' when 2 then 'marketing_' || strftime(data_carga, '%Y-%m-%d') || '.csv' "
        "when 3 then 'marketing_' || strftime(data_carga, '%Y') || '1340.csv' when 4 then 'MARKETING_' || strftime(data_carga, '%Y%m%d') || '.CSV' "
        "when 5 then 'marketing_' || strftime(data_carga, '%Y%m%d') || '.csv.bak' when 6 then 'marketing_' || strftime(data_carga, '%Y%m%d') || '.txt' "
        "else arquivo end as arquivo from entregas), lidos as (select arquivo, tamanho_bytes, "
        "cast(try_strptime(nullif(regexp_extract(lower(arquivo), '^marketing_([0-9]{8})[.]csv$', 1), ''), '%Y%m%d') as date) as d from nomes where lower(arquivo) like '%.csv') "
        f"select arquivo, tamanho_bytes, {o.iso('d')} as data_carga, cast(d is not null as integer) as nome_valido, "
        "'marketing_' || strftime(d, '%Y%m%d') || '.csv' as nome_esperado from lidos",
        "load_fingerprint": _fingerprint(),
        "load_plan": _plan(),
        "load_register": _register(),
        "load_discovery": _discovery(),
        "load_plan_redo": _plan(queries.date(1999, 3, 15), redo=True),
        "load_plan_copies": _plan().split("select " + o.iso("data_carga") + " as data_carga, arquivo")[0]
        + f"select {o.iso('d.data_carga')} as data_carga, {o.iso('e.data_carga')} as copia from dec d join estado e on e.impressao = d.impressao and e.data_carga <> d.data_carga where not d.pula and not d.tarde",
        "load_copies": f"{o.state()} select {o.iso('data_carga')} as data_carga, impressao, cargas from "
        "(select *, count(*) over (partition by impressao) as cargas from estado) where cargas > 1",
        "load_advance": f"{o.state()}, j as (select e.*, n.menor, n.linhas, e.status = 'BRONZE_OK' as espera, n.menor % 4 <> 0 as ok, n.arquivo as arq "
        "from estado e join entregas n on n.data_carga = e.data_carga) "
        f"select {o.iso('data_carga')} as data_carga, arquivo, case when espera and ok then 'SILVER_OK' when espera then 'ERRO_SILVER' else status end as status, "
        "tentativas, linhas_bronze, case when espera and ok then linhas else linhas_silver end as linhas_silver, "
        "case when espera and ok then 0 else linhas_quarentena end as linhas_quarentena, run_id_ultimo, "
        "case when espera and not ok then 'falha em ' || arq else mensagem end as mensagem from j",
        "last_success": f"{o.state()}, s as (select data_carga, row_number() over (order by data_carga desc) as n from estado where status = 'SUCESSO') "
        f"select {o.iso('max(case when n = 1 then data_carga end)')} as ultima, {o.iso('max(case when n = 2 then data_carga end)')} as anterior from s",
        "loads_in_state": f"{o.state()} select {o.iso('data_carga')} as data_carga, arquivo, tentativas from estado where run_id_ultimo = 'run-1' and status = 'SUCESSO'",
        "stage_active": f"with {LOG} select etapa, count(*) as execucoes, cast(case when etapa = 'view' then true else bool_and(status <> 'ERRO') end as integer) as etapa_ativa from log group by etapa",
        "resolve_params": "with t as (select l_partkey as k, cast(max(l_quantity) as integer) as q, count(*) as n from lineitem group by 1) "
        "select 'limite_' || p_partkey as parametro, cast(case when n % 2 = 0 then q else p_size end as varchar) as valor from part left join t on k = p_partkey",
    }
    places = {
        "category_share": "valor desc, rotulo",
        "channel_share": "valor desc, rotulo",
        "country_spend": "gasto desc, rotulo",
        "mean_with_gaps": "valor desc nulls last, rotulo",
        "income_band": _domain_order([*preset.INCOME_BANDS, preset.NOT_GIVEN]),
        "age_band": _domain_order([*[label for _, label in preset.AGE_BANDS], preset.AGE_ABOVE, preset.NOT_GIVEN]),
        "education_level": "nivel_ordem, rotulo",
        "loads_latest": "data_carga desc",
        "stage_duration": _listed("etapa", queries.STAGE_ORDER),
        "dq_latest": "severidade, regra",
        "inventory": _listed("camada", queries.LAYER_ORDER) + ", tabela",
        "loads_in_state": "data_carga",
    }
    return out | {name: _placed(out[name], order) for name, order in places.items()}
