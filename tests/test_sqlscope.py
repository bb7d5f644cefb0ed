"""Table lineage by scope: statements over schemas of our own, edges worked out by hand."""

from lakelens.operators import sqlscope

# statement -> (tables read, tables written)
SHAPES = {
    # plain reads
    "select * from harbor.ships": ("harbor.ships", ""),
    "SELECT s.name, p.city FROM ships s, ports AS p WHERE s.port = p.id": ("ships ports", ""),
    "select 1 from ships join crew on ships.id = crew.ship, ports p": ("ships crew ports", ""),
    'select a from "Sea"."Log Book" -- from nowhere\n/* join ghosts */ where b = \'from tides\'': ("sea.log book", ""),
    "select extract(year from sailed) from voyages": ("voyages", ""),
    "select * from ((berths b left join cranes c on b.id = c.berth) left join shifts using (day))": ("berths cranes shifts", ""),
    "select coalesce((select max(tide) from tides), 0), array(select id from buoys) from dual_t": ("tides buoys dual_t", ""),
    "select * from ships where id in (select ship from fines) or exists (select 1 from bans where bans.s = ships.id)": ("ships fines bans", ""),
    "select * from table(flow(3)) f, lateral split(f.x) l, ports": ("ports", ""),
    "select a is distinct from b from pairs": ("pairs", ""),
    "select k, v from maps lateral view explode(m) t as k, v": ("maps", ""),
    "select m from (values (1), (2)) as v(m), depths": ("depths", ""),
    # common table expressions and their scope
    "with orders as (select * from raw.orders) select * from orders": ("raw.orders", ""),
    "with orders as (select * from orders) select * from orders": ("orders", ""),
    "with a as (select * from t1), b as (select * from a join t2 on 1 = 1) select * from b, a, t3": ("t1 t2 t3", ""),
    "with a as (select * from t1) select * from sch.a": ("t1 sch.a", ""),
    "select * from (with w as (select * from t1) select * from w) x join w on true": ("t1 w", ""),
    "with a as (with b as (select * from t1) select * from b) select * from a, b": ("t1 b", ""),
    "with recursive up (id, boss) as (select id, boss from staff union all select s.id, s.boss from staff s join up on s.id = up.boss) "
    "select * from up": ("staff", ""),
    "with up as (select id from staff union all select id from up) select * from up": ("staff up", ""),
    "with a as materialized (select 1 from t1), b as not materialized (select 2 from t2) select * from a join b using (x)": ("t1 t2", ""),
    "with x as (select * from t1) select * from x; select * from x": ("t1 x", ""),
    # writes
    "insert into dock.log (ship, at) select ship, now() from arrivals": ("arrivals", "dock.log"),
    "insert overwrite table dock.log select * from arrivals": ("arrivals", "dock.log"),
    "insert into log with late as (select * from arrivals) select * from late": ("arrivals", "log"),
    "with late as (select * from arrivals) insert into log select * from late": ("arrivals", "log"),
    "insert all into hot (id) values (i) into cold values (i) select i from readings": ("readings", "hot cold"),
    "insert first when t > 30 then into hot when t > 10 then into mild else into cold select t from readings r, units": ("readings units", "hot mild cold"),
    "replace into gauges select * from readings": ("readings", "gauges"),
    "update ships s set flag = f.code from flags f where f.id = s.flag": ("ships flags", "ships"),
    "with f as (select * from flags) update ships set flag = f.code from f": ("flags ships", "ships"),
    "merge into ships t using (select * from news n join feeds on n.f = feeds.id) s on t.id = s.id when matched then update set t.x = s.x "
    "when not matched then insert (id, x) values (s.id, s.x)": ("news feeds", "ships"),
    "merge ships as t using news on t.id = news.id when matched then delete": ("news", "ships"),
    "delete from ships using bans where bans.ship = ships.id and bans.day in (select day from storms)": ("bans storms", ""),
    "create or replace transient table a.b as (select * from c)": ("c", "a.b"),
    "create view if not exists v (x, y) as select x, y from t union all select x, y from u": ("t u", "v"),
    "create or replace dynamic table d lag = '1 day' as select * from t": ("t", "d"),
    "create table copy_t clone main_t": ("main_t", "copy_t"),
    "create table t2 as select * from t where a like b": ("t", "t2"),
    "select id into fresh from stale": ("stale", "fresh"),
    "select * from ships for update of ships": ("ships", ""),
    # stages and loads
    "copy into ships from @stage/ships/2024 file_format = (type = csv)": ("", "ships"),
    "copy into @stage/out from (select * from ships)": ("ships", ""),
    "copy into ships (id, name) from (select $1, $2 from @stage/x)": ("", "ships"),
    "copy ships from 's3://bucket/x'": ("", "ships"),
    # nothing to find
    "grant select on ships to crew": ("", ""), "revoke select on ships from crew": ("", ""), "show tables from harbor": ("", ""),
    "drop table if exists ships": ("", ""), "create function f() returns int as 'select 1 from x'": ("", ""), "select 1": ("", ""), "": ("", ""),
    "))) from (((": ("", ""),
}


def edges(rows):
    got = {}
    for r in rows:
        got.setdefault(r.qid, {"source": [], "target": []})[r.role].append(r.table)
    return {q: {k: sorted(v) for k, v in e.items()} for q, e in got.items()}


def test_shapes(spark):
    names = {s: ([x for x in src.split(" ") if x], [x for x in tgt.split(" ") if x]) for s, (src, tgt) in SHAPES.items()}
    names['select a from "Sea"."Log Book" -- from nowhere\n/* join ghosts */ where b = \'from tides\''] = (["sea.log book"], [])
    df = spark.createDataFrame([(i, s) for i, s in enumerate(names)], "qid int, sql string")
    got = edges(sqlscope.table_lineage(df, "qid", "sql").collect())
    wrong = [(s, got.get(i), want) for i, (s, want) in enumerate(names.items())
             if got.get(i, {"source": [], "target": []}) != {"source": sorted(want[0]), "target": sorted(want[1])}]
    assert not wrong, wrong


def test_rows_of_one_id_stay_apart(spark):
    df = spark.createDataFrame([(1, "insert into x select * from a, b"), (1, "select c from (select d from e) f"), (None, "select * from g"), (2, None)],
                               "qid int, sql string")
    got = sorted((str(r.qid), r.role, r.table) for r in sqlscope.table_lineage(df, "qid", "sql").collect())
    assert got == [("1", "source", "a"), ("1", "source", "b"), ("1", "source", "e"), ("1", "target", "x"), ("None", "source", "g")]


def test_no_shuffle_and_long_statement(spark, capsys):
    wide = "select * from " + ", ".join(f"t{i}" for i in range(1500))
    deep = "select * from " + "(select * from " * 200 + "root" + ")" * 200
    found = sqlscope.table_lineage(spark.createDataFrame([(1, wide), (2, deep)], "qid int, sql string"), "qid", "sql")
    found.explain()
    assert "Exchange" not in capsys.readouterr().out
    rows = found.collect()
    assert sum(r.qid == 1 for r in rows) == 1500 and [r.table for r in rows if r.qid == 2] == ["root"]
