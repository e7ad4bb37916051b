"""Training-data operators (documents, pages, conversations).

Nothing else in the library imports this subpackage.  ``registry`` holds the
registered queries and their SQL twins; every other module is one operator with
a general DataFrame-in / DataFrame-out interface.
"""
