"""Personal data, and the terms around it that give it away.

Base spans are e-mail and IP addresses, card and phone numbers, found by their form. Hiding them is
not enough if a word of the same document speaks for them anyway. Over the whole corpus, the pointwise mutual
information of a term and an entity says how much of the entity's own information (the surprise at
meeting it in a document) the term gives: their ratio is the disclosure, 1 if the term never stands
in a document without the entity. In documents that hold the entity, such a term is generalised
wherever it stands, from one threshold on, and removed from a second.

    p(t) = documents with the term / all documents, p(e) likewise,
    p(t, e) = documents with both / all documents
    disclosure = log(p(t, e) / (p(t) p(e))) / -log p(e)

A term is a word of letters and digits. It counts only with `support` different texts that have it
and the entity: in one text, every rare word would give the entity away.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm import textops as X
from voxlake.llm.bitmap import key_bitmap, passes
from voxlake.llm.labels import joined
from voxlake.llm.storage import kept

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where its run of digits does, so no other place is tried
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")  # as X.ALPHANUMERIC has it
_LOWER = {c: c + 32 for c in range(65, 91)}


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with a domain behind it and a name before it; a name ends at the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        name = len(before) - len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if name else None
        if domain:
            yield at - name, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind in the order of KINDS."""
    found = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255
                   for part in m.group().split(".")):
                found.append((*m.span(), 1))
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((*m.span(), 2))
        if "+" in text:
            found += [(*m.span(), 3) for m in _PHONE.finditer(text)
                      if 9 <= len(_digits(m.group())) <= 15]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda s: (s[0], s[2]))]


def _entity(text: str, kind: str) -> str:
    """The same for every way of writing a number."""
    return kind + ":" + (text.lower() if kind in ("email", "ip") else _digits(text))


def _free(text: str, spans: list[dict]) -> list[tuple[int, int]]:
    """(start, end) of the terms outside all spans."""
    terms = [m.span() for m in _TERM.finditer(text)]
    covered = np.zeros(len(terms), bool)
    starts, ends = np.array([t[0] for t in terms], int), np.array([t[1] for t in terms], int)
    for s in spans:
        covered[np.searchsorted(ends, s["start"], "right"):np.searchsorted(starts, s["end"])] = True
    return [terms[i] for i in np.flatnonzero(~covered)]


def _hashes(texts: list[str]) -> np.ndarray:
    data, offsets = X.packed(pa.array(texts, pa.string()))
    return X.span_hashes(X.prefix_sums(data), offsets[:-1], offsets[1:])


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every term of the texts."""
    data = X.LOWER[data]
    starts, ends, owner = X.words(data, offsets, X.ALPHANUMERIC)
    return X.span_hashes(X.prefix_sums(data), starts, ends), owner


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
SPANS = "array<struct<start:bigint,end:bigint,kind:string>>"


def mentions(docs: DataFrame) -> DataFrame:
    """(id, name, base, entities, words) of every document; no words where there are no spans."""
    longs = pa.list_(pa.int64())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, names, sizes = [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                spans = base_spans(text)
                base.append([dict(start=a, end=b, kind=k) for a, b, k in spans])
                found = {_entity(text[a:b], k) for a, b, k in spans}
                names += found
                sizes.append(len(found))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            data, offsets = X.packed(pc.if_else(
                pa.array(ends[1:] > ends[:-1]), batch.column("text"), pa.scalar("")))
            words, places = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
            for a, b in X.pieces(offsets):
                hashes, owner = _terms(*X.cut(data, offsets, a, b))
                own, at = X.distinct_per_text(hashes, owner, b - a)
                words.append(own)
                places.append(at[1:] + places[-1][-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("name"), pa.array(base, pa.list_(_SPAN)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(
                     _hashes(names).view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(places).astype(np.int32)), pa.array(
                     np.concatenate(words).view(np.int64))).cast(longs)],
                ["id", "name", "base", "entities", "words"])

    return docs.select("id", F.xxhash64("text").alias("name"), "text").mapInArrow(
        work, f"id long, name long, base {SPANS}, entities array<long>, words array<long>")


def documents_with(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(term, n): how many documents have each wanted term; some other terms pass as well."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, offsets = X.packed(batch.column("text"))
            found = [np.zeros(0, np.uint64)]
            for a, b in X.pieces(offsets):
                terms, owner = _terms(*X.cut(texts, offsets, a, b))
                hit = passes(wanted, terms)
                found.append(X.distinct_per_text(terms[hit], owner[hit], b - a)[0])
            terms, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms.view(np.int64)), pa.array(n, pa.int64())], ["term", "n"])

    return (docs.select("text").mapInArrow(work, "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))


def recurring(rows: DataFrame, total: int, support: int) -> tuple[DataFrame, DataFrame]:
    """((name, copies, words, entities), (entity, of_entity)) of what can have terms.

    An entity in fewer than `support` different texts has no term, so it is left out. Equal texts
    are one row with the number of their copies.
    """
    firsts = rows.where(F.size("entities") > 0).groupBy("name").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"))
    each = kept(rows.select("id", "entities").join(firsts.select("id", "copies"), "id").select(
        "id", "copies", F.explode("entities").alias("entity")), "entities")
    entities = kept(each.groupBy("entity").agg(
        F.sum("copies").alias("of_entity"), F.count("*").alias("texts"))
        .where((F.col("texts") >= support) & (F.col("of_entity") < total)).drop("texts"), "recurring")
    texts = each.join(entities, "entity").groupBy("id", "copies").agg(
        F.collect_list("entity").alias("entities"))
    return kept(rows.select("id", "name", "words").join(texts, "id").drop("id"), "texts"), entities


def disclosures(texts: DataFrame, entities: DataFrame, docs: DataFrame, total: int,
                support: int = SUPPORT, least: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) from `least` on, over whole documents."""
    each = texts.select("copies", "words", F.explode("entities").alias("entity")).select(
        "copies", "entity", F.explode("words").alias("term"))
    pairs = kept(each.groupBy("entity", "term").agg(
        F.sum("copies").alias("together"), F.count("*").alias("texts"))
        .where(F.col("texts") >= support).drop("texts"), "pairs")
    terms = documents_with(docs, key_bitmap(pairs.select("term").distinct(), "term"))
    surprise = F.log(total / F.col("of_entity"))
    shared = F.log(total * F.col("together") / (F.col("n") * F.col("of_entity")))
    return (pairs.join(terms, "term").join(entities, "entity")
            .withColumn("disclosure", shared / surprise)
            .where(F.col("disclosure") >= least).select("entity", "term", "disclosure"))


def disclosing(texts: DataFrame, strong: DataFrame) -> DataFrame:
    """(name, terms): the terms of each text that disclose one of its entities, and how far."""
    wanted = key_bitmap(strong.select("term").distinct(), "term")

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            owner, flat = pc.list_parent_indices(words).to_numpy(), words.flatten().to_numpy()
            hit = passes(wanted, flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("name").take(pa.array(owner[hit])),
                 batch.column("entities").take(pa.array(owner[hit])), pa.array(flat[hit])],
                ["name", "entities", "term"])

    found = texts.select("name", "entities", "words").mapInArrow(
        sieve, "name long, entities array<long>, term long")
    return (found.select("name", "term", F.explode("entities").alias("entity"))
            .join(strong, ["entity", "term"])
            .groupBy("name", "term").agg(F.max("disclosure").alias("disclosure"))
            .groupBy("name").agg(F.collect_list(F.struct("term", "disclosure")).alias("terms")))


def occurrences(docs: DataFrame, remove: float) -> DataFrame:
    """(id, added): every place outside base spans where one of a document's terms stands."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = []
            for text, base, terms in zip(*(batch.column(c) for c in ("text", "base", "terms")),
                                         strict=True):
                text, known = text.as_py(), {t["term"]: t["disclosure"] for t in terms.as_py()}
                places = _free(text, base.as_py())
                hashes = _hashes([text[a:b].translate(_LOWER) for a, b in places]).view(np.int64)
                added.append([
                    dict(start=a, end=b, kind="remove" if known[t] >= remove else "generalise")
                    for (a, b), t in zip(places, hashes.tolist(), strict=True) if t in known])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(added, pa.list_(_SPAN))], ["id", "added"])

    return docs.select("id", "text", "base", "terms").mapInArrow(work, f"id long, added {SPANS}")


def sanitisation(docs: DataFrame, id: str = "doc_id", text: str = "text",
                 support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE
                 ) -> DataFrame:
    """One row per row of docs: id, base, added; both arrays of (start, end, kind).

    Positions are code points, ends exclusive. `base` are the personal data by form, `added` the
    terms that disclose an entity of the same document, wherever they stand in it: of kind `generalise` or `remove`, by the
    entity they disclose most. Documents without base spans get none. Null and empty texts have
    no spans but count as documents. Ids must be distinct integers; a row without one gives no
    row and counts nowhere. Other columns are ignored, so their names cannot clash.
    """
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where(
        "id is not null")
    rows = kept(mentions(docs), "mentions")
    total = rows.count()
    texts, entities = recurring(rows, total, support)
    strong = kept(disclosures(texts, entities, docs, total, support, generalise), "strong")
    marked = kept(rows.select("id", "name", "base").join(disclosing(texts, strong), "name"), "marked")
    # kept, for else a broadcast join puts sieve and search into one task, with a worker process each
    added = occurrences(kept(joined(docs, marked.drop("name")), "disclosed"), remove)
    return rows.select("id", "base").join(added, "id", "left").select(
        F.col("id").alias(id), "base", F.coalesce("added", F.array().cast(SPANS)).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end, joined by commas, by start and then kind in the order of KINDS."""
    kinds = F.array(*[F.lit(k) for k in (*KINDS, "generalise", "remove")])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("a"), F.array_position(kinds, s["kind"]).alias("k"),
        s["end"].alias("b"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(
        ":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))), ",")


def masked(docs: DataFrame, spans: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the spans of `sanitisation` replaced in the text: `<kind>`, or nothing for remove.

    Where spans overlap, the one that begins first is replaced together with all that touches it.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text_, spans_ in zip(batch.column(text), batch.column("__spans"), strict=True):
                whole, parts, done = text_.as_py(), [], 0
                for s in sorted(spans_.as_py() or [], key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= done:
                        parts += [whole[done:s["start"]],
                                  "" if s["kind"] == "remove" else
                                  "<term>" if s["kind"] == "generalise" else f"<{s['kind']}>"]
                    done = max(done, s["end"])
                out.append(whole if not parts else "".join(parts) + whole[done:])
            place = batch.schema.get_field_index(text)
            yield batch.set_column(place, text, pa.array(out, batch.schema.field(place).type)) \
                .drop_columns(["__spans"])

    hidden = spans.select(id, F.concat("base", "added").alias("__spans"))
    return docs.join(hidden, id, "left").select(*docs.columns, "__spans").mapInArrow(
        work, docs.schema)
