"""DataFrame -> DataFrame operators. None of them runs an action on its own,
except where a row count is needed to size a broadcast or a block layout."""
