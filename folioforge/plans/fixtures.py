"""Inputs of the registered queries, derived from the standard tables by rules that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parallel import spread
from ..operators.cleaning import ENTRY_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, and the text (null as empty)."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a path by id, size and content."""
    kind = F.when(F.col("id") % 3 == 0, "pdf_OCR_TXT").when(F.col("id") % 3 == 1, "djvu_OCR_TXT").otherwise("misc")
    tab = F.when(F.col("id") % 7 == 0, "/tab").otherwise("")
    rel = F.concat(F.lit("OCR_TXT/"), kind, tab, F.lit("/doc"), F.col("id").cast("string"), F.lit(".txt"))
    rows = documents(spark, sf_dir).withColumnRenamed("doc_id", "id").withColumn("txt_rel", rel)
    return rows.select("id", "txt_rel", F.concat(F.lit("/lib/"), "txt_rel").alias("txt_abs"), F.octet_length("text").cast("bigint").alias("size_bytes"), "text")


def colliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of which a hundred share a stem in turn: a folder by id, a name by the last two digits."""
    rows = documents(spark, sf_dir)
    rel = F.concat(F.lit("OCR_TXT/f"), F.lpad(F.floor(F.col("doc_id") / 100).cast("string"), 12, "0"), F.lit("/doc"), (F.col("doc_id") % 100).cast("string"), F.lit(".txt"))
    return rows.select(rel.alias("txt_rel"), "text", F.col("doc_id").alias("id"))


def mutated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as they are, with words or letters gone, or with lines of numbers added, by id."""
    t, k = F.col("text"), F.col("doc_id") % 4
    made = F.when(k == 1, F.regexp_replace(t, "[a-z]+", "7")).when(k == 2, F.regexp_replace(t, "[a-z]", " ")).when(k == 3, F.concat(t, F.lit("\n12\n12\n3 4\n-- 5 --"))).otherwise(t)
    return documents(spark, sf_dir).select("doc_id", made.alias("text"))


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty neighbouring documents as the pages of a book: (book, text)."""
    rows = documents(spark, sf_dir).withColumn("book", F.floor(F.col("doc_id") / 20))
    listed = F.array_sort(F.collect_list(F.struct("doc_id", "text")))
    return rows.groupBy("book").agg(F.array_join(F.transform(listed, lambda x: x["text"]), "\f").alias("text"))


def order_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as table pages: (doc_id, text)."""
    cols = ["l_linenumber", "l_partkey", "l_suppkey"]
    line = F.concat_ws(" | ", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
    listed = F.array_sort(F.collect_list(F.struct(*cols, line.alias("line"))))
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("text"))


def coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with classification codes and years put in by id: early or late, plausible or not, in either form."""
    n = F.col("doc_id")
    s = lambda c: c.cast("string")
    udc = F.when(n % 5 == 0, F.lit("")).when(n % 5 == 1, F.concat(F.lit("\nУДК "), s(n % 900 + 100), F.lit("."), s(n % 7), F.lit(" Основы"))).when(n % 5 == 2, F.concat(F.lit("\nУДК: "), s(n % 90 + 610), F.lit(".3 "))).when(n % 5 == 3, F.lit("\nУДК 51 Курс")).otherwise(F.concat(F.lit("УДК 004."), s(n % 10), F.lit(" и УДК 004."), s(n % 10), F.lit(" УДК 621.3 ")))
    bbk = F.when(n % 4 == 0, F.concat(F.lit("\nББК "), s(n % 80 + 20), F.lit("."), s(n % 9 + 1), F.lit("я"), s(n % 90 + 10), F.lit(". Авторы"))).when(n % 4 == 1, F.lit("\nББК нет")).otherwise("")
    year = F.when(n % 6 == 0, F.concat(F.lit(" М., "), s(n % 160 + 1862), F.lit(" г. изд."))).when(n % 6 == 1, F.concat(F.lit(" "), s(n % 100 + 1900), F.lit(" и 1987 год "))).otherwise("")
    return documents(spark, sf_dir).select("doc_id", F.when(n % 2 == 0, F.concat(udc, bbk, year, F.lit(" "), "text")).otherwise(F.concat("text", F.lit(" "), udc, bbk, year)).alias("text"))


#: File names with the year, authors, title and mode that the rules give them, worked out by hand.
NAMES = [
    ("Иванов А.Б. Книга (1987)", "1987", "Иванов А.Б.", "Книга", "initials_from_right"),
    ("Физика ()", "1111", "", "Физика", "no_initials"),
    ("Химия (год неизв.)", "1111", "", "Химия", "no_initials"),
    ("Сборник. Задачи 1975", "1975", "Сборник.", "Задачи", "noauthor_prefix"),
    ("Без авт. Справочник (12 kb)", None, "Без авт.", "Справочник", "noauthor_prefix"),
    ("Журнал. Радио 1980", "1980", "Журнал.", "Радио", "empty_author_prefix"),
    ("Landau_ Mechanics", None, "Landau_", "Mechanics", "empty_author_prefix"),
    ("Feynman_ Lectures", None, "Feynman_", "Lectures", "underscore_leading_word"),
    ("Петров - Основы связи", None, "Петров", "Основы связи", "hyphen_leading_author"),
    ("Смит Дж. Теория", None, "Смит Дж.", "Теория", "dj_initial_author"),
    ("А.Б. Сидоров - Оптика 1991", "1991", "Сидоров А.Б.", "Оптика", "initials_plus_hyphen_surname"),
    ("Кузнецов В.Г. (ред.) Металлы 2001", "2001", "Кузнецов В.Г. (ред.)", "Металлы", "initials_from_right"),
    ("Просто название.pdf", None, "", "Просто название", "no_initials"),
    ("Карты 191905", "1919", "", "Карты 05", "no_initials"),
    ("Труды ((())) 2031", "1111", "", "Труды 2031", "no_initials"),
]


def file_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n,) for n, *_ in NAMES], "name string")


#: Surnames of the library's authors.
SURNAMES = ("Иванов", "Петрова", "Сидоров", "Кузнецов", "Попова")


def library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a library, with names of every form that the name rules know (also with parentheses up to 60 deep), so that stems recur, and texts with codes and years; every fiftieth text can't be read."""
    n = F.col("doc_id")
    word = F.translate((n % 60).cast("string"), "0123456789", "абвгдежзик")
    year, author = (n % 100 + 1900).cast("string"), F.get(F.array(*map(F.lit, SURNAMES)), (n % 5).cast("int"))
    deep = (n % 60 + 1).cast("int")
    forms = [
        (author, " А.Б. Книга ", word, " (", year, ")"), ("Физика ", word, " ()"), ("Химия ", word, " (год неизв.)"), ("Сборник. Задачи ", word, " ", year), ("Без авт. Справочник ", word, " (12 kb)"),
        ("Журнал. Радио ", word, " ", year), ("Feynman_ Lectures ", word), (author, " - Основы ", word), (author, " Дж. Теория ", word), ("А.Б. ", author, " - Оптика ", word, " ", year),
        (author, " В.Г. (ред.) Металлы ", word, " ", year), (author, " А.Б. и др. Теория ", word, " Т. Поле"), (author, " В.Г. Основы ", word, " К. Том"), (author, " Д.Е. Оптика ", word, " Ф."),
        ("Труды ", word, " ", F.repeat(F.lit("( "), deep), F.repeat(F.lit(" )"), deep), " 2031"),
    ]
    joined = [F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in form]) for form in forms]
    name = F.get(F.array(*joined), (n % len(forms)).cast("int"))
    kind = F.when(n % 3 == 0, "pdf_OCR_TXT").when(n % 3 == 1, "djvu_OCR_TXT").otherwise("misc")
    tab = F.when(n % 7 == 0, "/tab").otherwise("")
    rel = F.concat(F.lit("OCR_TXT/"), kind, tab, F.lit("/f"), n.cast("string"), F.lit("/"), name, F.lit(".txt"))
    rows = coded(spark, sf_dir).select(n.alias("id"), name.alias("name"), rel.alias("txt_rel"), F.octet_length("text").cast("bigint").alias("size_bytes"), F.when(n % 50 != 49, F.col("text")).alias("text"))
    return rows.withColumn("txt_abs", F.concat(F.lit("/lib/"), "txt_rel"))


def library_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books of twenty pages under the library's names."""
    named = library(spark, sf_dir).select("id", "txt_rel", "txt_abs")
    rows = books(spark, sf_dir).join(named, F.col("book") == F.col("id")).drop("id")
    return rows.withColumn("size_bytes", F.octet_length("text").cast("bigint"))


def entry_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with line entries in one of the columns that may hold them, by id, put there in one of five ways.

    Entries carry a mark: 10 times the line's number. Ways, by id: 0 the filled lines, numbered; 1 the same backwards,
    with the first once more at the end, marked -1; 2 the filled lines without numbers; 3 these without the last; 4 all
    lines, with numbers that contradict their places. Every seventh document has them in the compact form.
    """
    n = F.col("doc_id")
    raw = F.split("text", "\n", -1)
    numbered = F.transform(raw, lambda s, i: F.struct((i + 1).alias("line_no"), ((i + 1) * 10).alias("text_len"), F.length(s).alias("token_count"), (F.trim(s, F.lit(" \t\r")) != "").alias("filled")))
    filled = F.filter(numbered, lambda x: x["filled"])
    with_number = lambda a, no: F.transform(a, lambda x, i: F.struct(no(x, i).cast("int").alias("line_no"), x["text_len"].alias("text_len"), x["token_count"].alias("token_count")))
    own, none, turned = (lambda x, i: x["line_no"]), (lambda x, i: F.lit(0)), (lambda x, i: 1000 - i)
    again = F.transform(F.slice(filled, 1, 1), lambda x: F.struct(x["line_no"].alias("line_no"), F.lit(-1).alias("text_len"), x["token_count"].alias("token_count")))
    ways = [with_number(filled, own), F.concat(F.reverse(with_number(filled, own)), again), with_number(filled, none), with_number(F.slice(filled, 1, F.greatest(F.size(filled) - 1, F.lit(0))), none), with_number(numbered, turned)]
    entries = F.when(n % 5 == 0, ways[0]).when(n % 5 == 1, ways[1]).when(n % 5 == 2, ways[2]).when(n % 5 == 3, ways[3]).otherwise(ways[4])
    rows = documents(spark, sf_dir).withColumn("entries", entries)
    # every column holds something of the wrong place or nothing, so the first filled one must win
    columns = [c for c in ENTRY_COLUMNS if c != "lines"]
    given = [F.when(n % 7 == k, F.col("entries")).when(n % 7 < k, F.transform("entries", lambda x: F.struct(x["line_no"].alias("line_no"), F.lit(-9).alias("text_len"), x["token_count"].alias("token_count")))).otherwise(F.slice("entries", 1, 0)).alias(c) for k, c in enumerate(columns)]
    compact = F.transform("entries", lambda x: F.array(x["text_len"].cast("string"), x["line_no"].cast("string"), x["token_count"].cast("string")))
    return rows.select("doc_id", "text", *given, F.when(n % 7 == 6, compact).alias("lines"), F.when(n % 7 == 6, F.array(*map(F.lit, ("text_len", "line_no", "token_count_simple")))).alias("lines_schema"))
