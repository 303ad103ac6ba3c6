"""dimflow: DataFrame operators that turn nested source documents into clean
tables, tracked history and a star schema."""
