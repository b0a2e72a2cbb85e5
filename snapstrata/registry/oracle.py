"""The registered queries once more as plain SQL, written from the definitions and not from the plans.

The snapshot is read once per cut date with a join on the dates, repeated keys and copies are found
with window functions, and versions with lag and lead over comparison texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from snapstrata.plans import customers as preset
from snapstrata.registry import binding
from snapstrata.registry.binding import DAYS, LATEST, Defects

MONEY = ["salario_anual", *preset.SPEND, "total_gasto"]
FLAGS = [*preset.CAMPAIGN_FLAGS, "comprou"]
LABELS = ["escolaridade", "estado_civil", "pais"]


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def day(d: date) -> str:
    return f"date '{d.isoformat()}'"


def iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def ymd(column: str) -> str:
    return f"cast(strftime({column}, '%Y%m%d') as integer)"


def double(column: str) -> str:
    return f"cast({column} as double)"


# ---------------------------------------------------------------------------- snapshot to silver
def raw(days: Sequence[date], defects: Defects = Defects(), name: str = "raw") -> str:
    """CTEs ending in ``name``: the text rows of the snapshot contract with load date and sequence."""
    def hit(rule: str) -> str:
        divisor, remainder = defects.where[rule]
        return f"k % {divisor} = {remainder}"

    salary = "cast(cast(abs(c_acctbal) as decimal(12,2)) as varchar)"
    level = " ".join(f"when {quoted(s)} then {quoted(e)}" for s, e in zip(binding.SEGMENTS, preset.EDUCATION_ORDER))
    marital = " ".join(f"when {i} then {quoted(m)}" for i, m in enumerate(preset.MARITAL_STATUS))

    def count(column: str) -> str:
        return f"cast(coalesce({column}, 0) as varchar)"

    normal = {
        "ano_nascimento": "cast(1940 + k % 55 as varchar)",
        "escolaridade": f"case c_mktsegment {level} end",
        "estado_civil": f"case coalesce(pedidos, 0) % 3 {marital} end",
        "salario_anual": salary,
        "qtd_filhos": "cast(k % 4 as varchar)",
        "qtd_adolescentes": "cast(k % 3 as varchar)",
        "data_cadastro": "extract(day from primeiro) || '/' || extract(month from primeiro) || '/' || extract(year from primeiro)",
        "dias_desde_ultima_compra": "cast(date_diff('day', ultimo, dia) as varchar)",
        **{c: f"cast(cast(coalesce({c}, 0) as decimal(18,2)) as varchar)" for c in preset.SPEND},
        "qtd_compras_desconto": count("desconto"),
        **{c: count(c) for c in preset.CHANNEL_COUNTS},
        "visitas_website_mes": count("visitas"),
        **{c: count(c) for c in preset.CAMPAIGN_FLAGS},
        "comprou": "case when date_diff('day', ultimo, dia) < 365 then '1' else '0' end",
        "pais": "n_name",
    }
    broken = {
        "ano_nascimento": [("A003", "'1893'")],
        "escolaridade": [("A006", "'Desconhecido'")],
        "salario_anual": [("R004", f"'-' || {salary}"), ("A001", "''"), ("A002", "'666666'")],
        "data_cadastro": [("R003", "'31/02/2022'"), ("A005", "'15/03/2030'")],
        **{c: [("A007", "'abc'")] for c in binding.UNREADABLE},
    }

    def content(column: str) -> str:
        cases = [(hit("A004"), quoted(binding.TWIN_ROW[column]))]
        cases += [(hit(rule), value) for rule, value in broken.get(column, [])]
        whens = " ".join(f"when {c} then {v}" for c, v in cases)
        return f"case {whens} else {normal[column]} end as {column}"

    columns = [
        f"case when {hit('R001')} then 'X' || k else cast(k as varchar) end as id_cliente"
        if c == "id_cliente"
        else content(c)
        for c in preset.COLUMNS
    ]
    cuts = ", ".join(f"({day(d)})" for d in days)
    spend = ", ".join(
        f"sum(case when p_type = {quoted(t)} then cast(l_extendedprice as decimal(18,2)) end) as {c}"
        for c, t in zip(preset.SPEND, binding.P_TYPES)
    )
    channels = ", ".join(
        f"sum(case when o_orderstatus = {quoted(s)} then 1 else 0 end) as {c}"
        for c, s in zip(preset.CHANNEL_COUNTS, binding.STATUSES)
    )
    campaigns = ", ".join(
        f"max(case when o_orderpriority = {quoted(p)} then 1 else 0 end) as {c}"
        for c, p in zip(preset.CAMPAIGN_FLAGS, binding.PRIORITIES)
    )
    return f"""
{name}_cuts(dia) as (values {cuts}),
{name}_o as (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, cast(o_orderdate as date) as od from orders),
{name}_ord as (
  select dia, o_custkey as k, count(*) as pedidos, min(od) as primeiro, max(od) as ultimo, {channels}, {campaigns}
  from {name}_cuts join {name}_o on od <= dia group by all),
{name}_lin as (
  select dia, o_custkey as k, {spend}, sum(case when l_discount > 0 then 1 else 0 end) as desconto
  from {name}_cuts join {name}_o on od <= dia join lineitem on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey group by all),
{name}_vis as (select user_id as k, count(*) as visitas from events where event_type = 'view' group by 1),
{name}_all as (
  select c.c_custkey as k, c.c_acctbal, c.c_mktsegment, n.n_name, d.dia, o.* exclude (dia, k), l.* exclude (dia, k), v.visitas
  from customer c cross join {name}_cuts d
  left join nation n on n.n_nationkey = c.c_nationkey
  left join {name}_ord o on o.k = c.c_custkey and o.dia = d.dia
  left join {name}_lin l on l.k = c.c_custkey and l.dia = d.dia
  left join {name}_vis v on v.k = c.c_custkey),
{name} as (
  select {', '.join(columns)}, dia, k * 2 + copia as seq
  from (select *, unnest(case when {hit('R002')} then [0, 1] else [0] end) as copia from {name}_all))"""


def _whole(c: str, kind: str) -> str:
    return f"try_cast(case when regexp_matches(trim({c}), '^[+-]?[0-9]+$') then trim({c}) end as {kind})"


def typed(source: str = "raw", name: str = "typed") -> str:
    out = []
    for f in preset.FIELDS:
        c = f.name
        if f.kind == "text":
            value = f"nullif(trim({c}), '')"
        elif f.kind == "flag":
            value = f"({_whole(c, 'integer')} = 1)"
        elif f.kind == "date":
            shape = f"regexp_matches(trim({c}), '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$')"
            value = f"cast(case when {shape} then try_strptime(trim({c}), '%d/%m/%Y') end as date)"
        elif f.kind.startswith("decimal"):
            value = f"try_cast(nullif(trim({c}), '') as {f.kind})"
        else:
            value = _whole(c, f.kind)
        out.append(f"{value} as {c}")
    return f"\n{name} as (select {', '.join(out)}, id_cliente as id_cliente_raw, dia, seq from {source})"


def text_of(columns: Sequence[str], sep: str) -> str:
    return f"concat_ws('{sep}', " + ", ".join(f"coalesce(cast({c} as varchar), '<null>')" for c in columns) + ")"


RULE_CODES = {
    "r001": "R001_ID_INVALIDO",
    "r002": "R002_ID_DUPLICADO",
    "r003": "R003_DATA_CADASTRO_INVALIDA",
    "r004": "R004_VALOR_NEGATIVO",
    "a001": "A001_SALARIO_AUSENTE",
    "a002": "A002_SALARIO_OUTLIER",
    "a003": "A003_ANO_NASCIMENTO_INVALIDO",
    "a004": "A004_POSSIVEL_DUPLICADO",
    "a005": "A005_DATA_CADASTRO_FUTURA",
    "a006": "A006_DOMINIO_DESCONHECIDO",
    "a007": "A007_VALOR_NAO_NUMERICO",
}
ACTIONS = {"r": ("BLOQUEANTE", "QUARENTENA"), "a": ("ALERTA", "SINALIZAR")}


def flags(source: str = "typed", name: str = "flags") -> str:
    numeric = [*preset.SPEND, *preset.COUNTS, "salario_anual"]
    present = [*preset.SPEND, *preset.COUNTS, *FLAGS]
    levels = ", ".join(quoted(x) for x in preset.EDUCATION_ORDER)
    marital = ", ".join(quoted(x) for x in preset.MARITAL_STATUS)
    conditions = {
        "r001": "id_cliente is null",
        "r002": "id_cliente is not null and vez > 1",
        "r003": "data_cadastro is null",
        "r004": " or ".join(f"coalesce({c} < 0, false)" for c in numeric),
        "a001": "salario_anual is null",
        "a002": "salario_anual > 300000",
        "a003": "ano_nascimento is null or ano_nascimento < 1900 or ano_nascimento > extract(year from dia)",
        "a004": "copias > 1",
        "a005": "data_cadastro > dia",
        "a006": f"escolaridade is null or escolaridade not in ({levels}) or estado_civil is null or estado_civil not in ({marital})",
        "a007": " or ".join(f"{c} is null" for c in present),
    }
    marks = ", ".join(f"coalesce({c}, false) as {n}" for n, c in conditions.items())
    return f"""
{name}_h as (select *, sha256({text_of(preset.CONTENT, '|')}) as hash_conteudo from {source}),
{name}_w as (
  select *, row_number() over (partition by dia, id_cliente order by seq) as vez,
    count(*) over (partition by dia, hash_conteudo) as copias from {name}_h),
{name}_m as (select *, {marks} from {name}_w),
{name} as (select *, (r001 or r002 or r003 or r004) as bloqueado from {name}_m)"""


def codes(prefix: str) -> str:
    parts = ", ".join(f"case when {n} then {quoted(c)} end" for n, c in RULE_CODES.items() if n[0] == prefix)
    return f"concat_ws(',', {parts})"


def silver(source: str = "flags", name: str = "silver") -> str:
    def total(columns: Sequence[str], kind: str) -> str:
        return " + ".join(f"coalesce(cast({c} as {kind}), 0)" for c in columns)

    labels = ", ".join(f"coalesce({c}, {quoted(preset.NOT_GIVEN)}) as {c}" for c in LABELS)
    rest = [
        "salario_anual", "qtd_filhos", "qtd_adolescentes", "data_cadastro", "dias_desde_ultima_compra",
        *preset.SPEND, "qtd_compras_desconto", *preset.CHANNEL_COUNTS, "visitas_website_mes",
        *preset.CAMPAIGN_FLAGS, "comprou", "hash_conteudo", "dia",
    ]
    return f"""
{name} as (
  select id_cliente, case when a003 then null else ano_nascimento end as ano_nascimento, {labels}, {', '.join(rest)},
    cast({total(preset.SPEND, 'decimal(14,2)')} as decimal(14,2)) as total_gasto,
    cast({total(preset.CHANNEL_COUNTS, 'integer')} as integer) as total_compras,
    cast({total(preset.CAMPAIGN_FLAGS, 'integer')} as integer) as qtd_campanhas_aceitas,
    {codes('a')} as dq_alertas
  from {source} where not bloqueado)"""


def through(stage: str, days: Sequence[date] = (LATEST,), defects: Defects = Defects()) -> str:
    """``with`` clause up to a stage: raw, typed, flags or silver."""
    steps = [raw(days, defects), typed(), flags(), silver()]
    names = ["raw", "typed", "flags", "silver"]
    return "with " + ",".join(steps[: names.index(stage) + 1])


# ---------------------------------------------------------------------------- versions and facts
def income_band(c: str) -> str:
    return (
        f"case when {c} is null then 'Não Informado' when {c} <= 30000 then 'Baixa' "
        f"when {c} <= 60000 then 'Média' when {c} <= 100000 then 'Alta' else 'Muito Alta' end"
    )


def age_band(c: str) -> str:
    return (
        f"case when {c} is null then 'Não Informado' when {c} < 40 then 'Até 39' when {c} < 50 then '40-49' "
        f"when {c} < 60 then '50-59' when {c} < 70 then '60-69' else '70+' end"
    )


def versions(source: str = "silver", name: str = "dim") -> str:
    return f"""
{name}_s as (
  select id_cliente, ano_nascimento, escolaridade, estado_civil, pais, salario_anual,
    {income_band('salario_anual')} as faixa_salarial, qtd_filhos, qtd_adolescentes, data_cadastro,
    sha256({text_of(preset.TRACKED, '|')}) as hash_atributos, dia from {source}),
{name}_l as (select *, lag(hash_atributos) over (partition by id_cliente order by dia) as antes from {name}_s),
{name}_v as (select * from {name}_l where antes is null or antes <> hash_atributos),
{name} as (
  select * exclude (dia, antes), dia as inicio_vigencia,
    coalesce(cast(lead(dia) over (partition by id_cliente order by dia) - interval 1 day as date), date '9999-12-31') as fim_vigencia,
    lead(dia) over (partition by id_cliente order by dia) is null as flag_atual
  from {name}_v)"""


def snapshot_fact(where: str = "true", name: str = "fato", source: str = "silver", dim: str = "dim") -> str:
    age = "(cast(extract(year from s.dia) as integer) - s.ano_nascimento)"
    return f"""
{name} as (
  select s.*, d.inicio_vigencia, d.faixa_salarial, {age} as idade, {age_band(age)} as faixa_etaria
  from {source} s join {dim} d on d.id_cliente = s.id_cliente and s.dia between d.inicio_vigencia and d.fim_vigencia
  where {where})"""


def domain_fact(domain: dict[str, tuple[str, str]], value: str, label: str, kind: str, source: str = "fato", name: str = "longo") -> str:
    parts = [
        f"select id_cliente, dia, {quoted(code)} as codigo, {quoted(text)} as {label}, cast({c} as {kind}) as {value} from {source}"
        for code, (text, c) in domain.items()
    ]
    return f"\n{name} as ({' union all '.join(parts)})"


def star(where: str = f"s.dia = {day(LATEST)}") -> str:
    return through("silver", DAYS) + "," + versions() + "," + snapshot_fact(where)


VERSION_COLUMNS = f"""id_cliente, ano_nascimento, escolaridade, estado_civil, pais, {double('salario_anual')} as salario_anual,
  faixa_salarial, qtd_filhos, qtd_adolescentes, {iso('data_cadastro')} as data_cadastro, hash_atributos,
  {iso('inicio_vigencia')} as inicio_vigencia, case when flag_atual then '9999-12-31' else {iso('fim_vigencia')} end as fim_vigencia,
  cast(flag_atual as integer) as flag_atual"""


def delta(measures: Sequence[str], source: str = "kpi") -> str:
    parts = [
        f"select sk_data_carga, {quoted(m)} as medida, cast({m} as double) as valor, "
        f"lag(cast({m} as double)) over (order by sk_data_carga) as anterior from {source}"
        for m in measures
    ]
    change = "(valor - anterior) / abs(anterior) * 100"
    return f"""
  select sk_data_carga, medida, round(valor, 6) as valor, round(anterior, 6) as anterior,
    round(case when anterior <> 0 then {change} end, 6) as variacao_pct,
    case when anterior = 0 then 'sem base' when abs({change}) < 0.05 then 'neutro'
      when {change} > 0 then 'sobe' when {change} < 0 then 'desce' end as direcao
  from ({' union all '.join(parts)})"""


# ---------------------------------------------------------------------------- load states
def deliveries(name: str = "entregas") -> str:
    return f"""
{name}_d as (
  select cast(o_orderdate as date) as data_carga, count(*) as linhas, min(o_orderkey) as menor,
    sum(cast(o_totalprice as decimal(18,2))) as total
  from orders group by 1),
{name} as (
  select data_carga, 'marketing_' || strftime(data_carga, '%Y%m%d') || '.csv' as arquivo, linhas, menor,
    case when extract(day from data_carga) = 15 then 'mes-' || extract(month from data_carga)
      else linhas || '-' || menor || '-' || cast(total as varchar) end as impressao
  from {name}_d)"""


def load_state(name: str = "estado", source: str = "entregas", some: bool = False) -> str:
    where = f"where data_carga <= {day(binding.STATE_UNTIL)} and menor % 3 <> 0" if some else ""
    states = " ".join(f"when {i} then {quoted(s)}" for i, s in enumerate(binding.LOAD_STATES))
    return f"""
{name} as (select *, case when status like 'ERRO%' then 'falha em ' || arquivo end as mensagem from (
  select data_carga, arquivo, case menor % {len(binding.LOAD_STATES)} {states} end as status,
    cast(linhas % 5 + 1 as integer) as tentativas, impressao, linhas * 10 as linhas_bronze,
    linhas * 10 - menor % 7 as linhas_silver, menor % 7 as linhas_quarentena,
    'run-' || (menor % 4) as run_id_ultimo, linhas * 120 + menor % 97 as tamanho_bytes,
    strftime(data_carga, '%Y-%m-%d') || printf(' %02d:00:00', menor % 24) as atualizado_em
  from {source} {where}))"""


def state(some: bool = False) -> str:
    return "with " + deliveries() + "," + load_state(some=some)
