"""Jobs and the query registry.

``jobs``      the four batch stages (etl, marts, train, export) with a CLI
``registry``  one DataFrame-returning query per operator group (driver gate)
``oracle``    the DuckDB SQL each registered query is checked against
"""
