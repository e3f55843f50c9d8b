def frame_of(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}
