"""Training-data operators over document, page and benchmark tables.

One module per operator; ``queries`` registers them. Nothing else in the
package imports this subpackage.
"""
