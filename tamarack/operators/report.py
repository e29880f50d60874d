"""Report frames: aggregates, pivots, pairings, series and filters; and what is written from them."""

from __future__ import annotations

import html as _html
import json
import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def summary(specs: DataFrame) -> DataFrame:
    """One row: distinct brands and models, rows, mean confidence (two decimals)."""
    return specs.agg(F.count_distinct("brand").alias("brands"), F.count_distinct("model").alias("models"), F.count("*").alias("specs"), F.round(F.avg("confidence"), 2).alias("avg_confidence"))


def specs_per_brand(specs: DataFrame) -> DataFrame:
    return specs.groupBy("brand").agg(F.count("parameter").alias("specs"))


def parameter_frequency(specs: DataFrame) -> DataFrame:
    return specs.groupBy("parameter").agg(F.count("*").alias("specs")).orderBy(F.desc("specs"), "parameter")


def pivot(specs: DataFrame, parameters: list[str], order: str = "id") -> DataFrame:
    """A row per machine and a column per parameter with its first value that isn't null, in the order of ``order``. Naming the parameters saves a pass."""
    first = lambda p: F.min_by("value", F.when((F.col("parameter") == p) & F.col("value").isNotNull(), F.col(order))).alias(p)
    return specs.groupBy("brand", "model", "equipment_type").agg(*map(first, parameters))


def paired(specs: DataFrame, a: str, b: str, order: str = "id") -> DataFrame:
    """(model, a, b): the first value of each of two parameters of a model, both present."""
    first = lambda p: F.min_by("value", F.when(F.col("parameter") == p, F.col(order)))
    return specs.where(F.col("parameter").isin(a, b) & F.col("value").isNotNull()).groupBy("model").agg(first(a).alias(a), first(b).alias(b)).dropna(subset=[a, b])


def heatmap(specs: DataFrame, order: str = "id") -> DataFrame:
    """The dense grid of models and parameters with the first confidence of each cell, or null."""
    first = specs.groupBy("model", "parameter").agg(F.min_by("confidence", order).alias("confidence"))
    models, parameters = specs.select("model").distinct(), specs.select("parameter").distinct()
    # the grid is the result: a parameter table's few rows meet each model
    grid = models.crossJoin(parameters)
    on = [grid["model"].eqNullSafe(first["model"]), grid["parameter"].eqNullSafe(first["parameter"])]
    return grid.join(first, on, "left").select(grid["model"], grid["parameter"], "confidence")


def confidence_band(confidence: Column) -> Column:
    return F.when(confidence >= 0.7, "high").when(confidence >= 0.5, "mid").otherwise("low")


def filtered(specs: DataFrame, brand: str | None = None, parameter: str | None = None, least: float = 0.0, model: str | None = None) -> DataFrame:
    """The report's filters: brand and parameter equal, confidence at least, model contains (case ignored)."""
    out = specs.where(F.col("confidence") >= least) if least else specs
    out = out.where(F.col("brand") == brand) if brand else out
    out = out.where(F.col("parameter") == parameter) if parameter else out
    return out.where(F.contains(F.lower("model"), F.lit(model.lower()))) if model else out


def sorted_by(specs: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Sorted as text, confidence as a number."""
    key = F.col(column) if column == "confidence" else F.col(column).cast("string")
    return specs.orderBy(F.desc(key) if descending else F.asc(key))


def series(points: DataFrame, by_speed: bool = False) -> DataFrame:
    """(brand, model, place, gear, speed_kmh, force_kn): the curve of each machine in the order of gears, or of speeds without the points that have none; rows, so that no curve is gathered."""
    from .curves import gear_rank

    p = points.where(F.col("speed_kmh").isNotNull()) if by_speed else points
    at = F.col("speed_kmh") if by_speed else gear_rank(F.col("gear"))
    along = Window.partitionBy("brand", "model").orderBy(at, "gear", "speed_kmh", "force_kn")
    return p.select("brand", "model", F.row_number().over(along).alias("place"), "gear", "speed_kmh", "force_kn")


def file_name(brand: Column) -> Column:
    """A brand's name as a file's: blanks as _, other signs dropped, 30 characters."""
    return F.substring(F.regexp_replace(F.replace(brand, F.lit(" "), F.lit("_")), r"[^A-Za-z0-9_-]", ""), 1, 30)


def json_for_html(frame: Column) -> Column:
    """JSON that can't end a script element or open a comment."""
    j = F.to_json(frame)
    return F.replace(F.replace(j, F.lit("</"), F.lit("<\\/")), F.lit("<!--"), F.lit("<\\!--"))


_CSV = {"header": True, "encoding": "UTF-8", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def csv_reader(spark):
    """A reader that gives back what is written here; blanks at the ends, quotes and line ends in cells are kept."""
    return spark.read.options(**_CSV, multiLine=True)


def write_search_csv(results: DataFrame, path: str) -> None:
    results.select("brand", "model", "title", "url", "snippet", "source_engine", "query").write.mode("overwrite").options(**_CSV).csv(path)


def write_csv(specs: DataFrame, path: str, per_brand: bool = True) -> None:
    """All specs, and a folder per brand."""
    specs.write.mode("overwrite").options(**_CSV).csv(f"{path}/all_specs")
    if per_brand:
        specs.withColumn("brand_file", file_name(F.col("brand"))).repartition("brand_file").write.mode("overwrite").options(**_CSV).partitionBy("brand_file").csv(f"{path}/by_brand")


def write_pivot(specs: DataFrame, parameters: list[str], path: str) -> None:
    """The pivot as CSV, in the order of brands and models."""
    pivot(specs, parameters, "extracted_at").orderBy("brand", "model").write.mode("overwrite").options(**_CSV).csv(path)


def write_inventory(machines: DataFrame, path: str) -> None:
    """Models by tier, brand and category as one CSV file; as many rows as brands have categories."""
    from .search import inventory_by_tier

    inventory_by_tier(machines).orderBy("tier", "brand", "category").coalesce(1).write.mode("overwrite").options(**_CSV).csv(path)


def summary_json(specs: DataFrame) -> str:
    """Counts as one JSON text; as many entries as there are brands and parameters."""
    s = summary(specs).first().asDict()
    s["specs_per_brand"] = {r.brand: r.specs for r in specs_per_brand(specs).collect()}
    s["parameter_frequency"] = {r.parameter: r.specs for r in parameter_frequency(specs).collect()}
    return json.dumps(s, ensure_ascii=False, indent=2)


_PAGE = """<!doctype html><html><head><meta charset="utf-8"><title>%(title)s</title>
<style>body{font-family:sans-serif;margin:2em}td,th{padding:2px 8px;text-align:left}.high{background:#cfe8cf}.mid{background:#f5ebc4}.low{background:#f3cfcf}svg{display:block;margin:1em 0}</style></head><body>
<h1>%(title)s</h1><p id="totals"></p><h2>Specs per brand</h2><svg id="brands"></svg><h2>Parameters</h2><svg id="parameters"></svg>
<h2>Brand</h2><select id="brand"></select> <select id="model"></select> <input id="q" placeholder="filter"><h2>Force by gear</h2><svg id="curves" width="640" height="260"></svg><h2>Confidence</h2><table id="heat"></table><h2>Specs</h2><table id="rows"></table>
<script>const report=%(data)s;</script>
<script>
"use strict";
const $=i=>document.getElementById(i),NS="http://www.w3.org/2000/svg";let rows=[],points=[];
function row(r){rows.push(r)} function point(p){points.push(p)}
function node(tag,at,text){const e=document.createElementNS(NS,tag);for(const k in at)e.setAttribute(k,at[k]);if(text!==undefined)e.textContent=text;return e}
function bars(id,data){const svg=$(id),most=Math.max(1,...data.map(d=>d[1]));svg.setAttribute("width",720);svg.setAttribute("height",20*data.length+4);
 data.forEach((d,i)=>{svg.append(node("text",{x:0,y:20*i+14,"font-size":12},d[0]),node("rect",{x:220,y:20*i+3,width:420*d[1]/most,height:14,fill:"#4878a8"}),node("text",{x:226+420*d[1]/most,y:20*i+14,"font-size":12},d[1]))})}
function curves(){const svg=$("curves");svg.textContent="";const by={};for(const p of points)(by[p.model]??=[]).push(p);const names=Object.keys(by),most=Math.max(1,...points.map(p=>p.force_kn)),wide=Math.max(2,...names.map(n=>by[n].length));
 names.forEach((n,i)=>{const c="hsl("+360*i/names.length+",60%%,40%%)",ps=by[n].sort((a,b)=>a.place-b.place);
  svg.append(node("polyline",{fill:"none",stroke:c,points:ps.map((p,j)=>[20+600*j/(wide-1),240-220*p.force_kn/most].join()).join(" ")}));ps.forEach((p,j)=>{const dot=node("circle",{cx:20+600*j/(wide-1),cy:240-220*p.force_kn/most,r:3,fill:c});dot.append(node("title",{},n+" "+p.gear+": "+p.force_kn+" kN"));svg.append(dot)})})}
function band(c){return c==null?"":c>=0.7?"high":c>=0.5?"mid":"low"}
function draw(){const q=$("q").value.toLowerCase(),t=$("rows"),cols=["model","equipment_type","parameter","value","unit","confidence","source_url"];t.textContent="";const h=t.insertRow();for(const c of cols)h.insertCell().textContent=c;
 const only=$("model").value;for(const r of rows)if((!only||r.model===only)&&JSON.stringify(r).toLowerCase().includes(q)){const tr=t.insertRow();for(const c of cols)tr.insertCell().textContent=r[c]??"";tr.className=band(r.confidence)}
 const heat=$("heat"),models=[...new Set(rows.map(r=>r.model))].sort(),ps=[...new Set(rows.map(r=>r.parameter))].sort(),first={};heat.textContent="";for(const r of rows)first[r.model+"|"+r.parameter]??=r.confidence;
 const top=heat.insertRow();top.insertCell();for(const p of ps)top.insertCell().textContent=p;for(const m of models){const tr=heat.insertRow();tr.insertCell().textContent=m;for(const p of ps){const c=tr.insertCell(),v=first[m+"|"+p];c.textContent=v??"";c.className=band(v)}}curves()}
function load(brand){$("model").textContent="";for(const m of ["",...(report.models[brand]||[])]){const o=document.createElement("option");o.textContent=o.value=m;$("model").append(o)}rows=[];points=[];const files=report.files[brand]||[];let left=files.length;if(!left)draw();for(const f of files){const s=document.createElement("script");s.src=f;s.onload=s.onerror=()=>{if(!--left)draw()};document.body.append(s)}}
$("totals").textContent=report.totals;bars("brands",report.brands);bars("parameters",report.parameters);
for(const b of Object.keys(report.files)){const o=document.createElement("option");o.textContent=o.value=b;$("brand").append(o)}
$("brand").addEventListener("change",e=>load(e.target.value));$("q").addEventListener("input",draw);$("model").addEventListener("change",draw);load($("brand").value);
</script></body></html>"""


def html_report(specs: DataFrame, path: str, title: str = "Technical specifications", points: DataFrame | None = None) -> str:
    """A page with totals, charts, a heatmap, curves and all specs; "" when there are none.

    Every spec is in the report: tasks write the rows of each brand, and of its curves
    (points: brand, model, place, gear, force_kn), as scripts beside the page, which it loads
    when the brand is chosen. The driver sees counts per brand and parameter, and file names.
    """
    counts = specs_per_brand(specs).orderBy("brand").collect()
    if not counts:
        return ""
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    line = lambda df, call, cols: df.select(F.coalesce(file_name(F.col("brand")), F.lit("")).alias("brand_file"), F.concat(F.lit(f"{call}("), json_for_html(F.struct(*cols)), F.lit(");")).alias("value"))
    lines = line(specs, "row", ["model", "equipment_type", "parameter", "value", "unit", "confidence", *(["source_url"] if "source_url" in specs.columns else [])])
    if points is not None:
        lines = lines.unionByName(line(points, "point", ["model", "place", "gear", "force_kn"]))
    data = os.path.join(folder, "data")
    target = data if "://" in data else "file://" + os.path.abspath(data)
    lines.repartition("brand_file").write.mode("overwrite").partitionBy("brand_file").text(target)
    files: dict[str, list[str]] = {}
    for brand, key in specs.select("brand", F.coalesce(file_name(F.col("brand")), F.lit("")).alias("k")).distinct().orderBy("brand").collect():  # a row a brand
        part = f"brand_file={key or '__HIVE_DEFAULT_PARTITION__'}"
        at = os.path.join(data, part)
        names = sorted(n for n in os.listdir(at) if n.startswith("part-")) if os.path.isdir(at) else []
        for n in [n for n in names if not n.endswith(".js")]:
            os.rename(os.path.join(at, n), os.path.join(at, n.removesuffix(".txt") + ".js"))
        files[brand or ""] = [f"data/{part}/{n.removesuffix('.txt').removesuffix('.js')}.js" for n in names]
    s = summary(specs).first()
    shown = {
        "totals": f"{s.brands} brands, {s.models} models, {s.specs} specs, mean confidence {s.avg_confidence}",
        "brands": [[r.brand or "", r.specs] for r in counts],
        "parameters": [[r.parameter or "", r.specs] for r in parameter_frequency(specs).collect()],
        "files": files,
        "models": {r.brand or "": sorted(r.models) for r in specs.groupBy("brand").agg(F.collect_set("model").alias("models")).collect()},  # the machines, a dimension
    }
    safe = json.dumps(shown, ensure_ascii=False).replace("</", "<\\/").replace("<!--", "<\\!--")
    with open(path, "w", encoding="utf-8") as f:
        f.write(_PAGE % {"title": _html.escape(title), "data": safe})
    return path
