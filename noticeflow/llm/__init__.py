"""Operations of a training-data pipeline over ``documents`` and friends.

Nothing outside this folder imports it; ``__spark_entry__`` registers its
queries only when the folder is there.
"""
