from fieldmart.llm.common import table
from fieldmart.llm.treemodel import extract


def op2_html_tree(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


QUERIES = [("op2_html_tree", op2_html_tree, None)]
