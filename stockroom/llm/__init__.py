"""Training-data operators over documents, vectors and conversations.

One module per operator; ``queries`` registers one query for each. Nothing
else in the library imports this subpackage.
"""
