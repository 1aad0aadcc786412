"""Training-data operators: one module for each operator, one registry for their queries.

Nothing else in the library imports this subpackage.  Common rules, unless an
operator's docstring says otherwise:

* null and empty texts are valid rows and get the operator's empty result;
* rows are never merged by id alone: repeated rows each get a result, and rows
  that share an id but not a text are separate documents;
* columns an operator does not name are ignored or carried unread; an output
  column replaces an input column of the same name;
* empty tables give empty results with the same schema.
"""
